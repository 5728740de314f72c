"""Main text of one HTML page by the distribution of text over its lines.

A page is stripped to lines, one per block element. Each line has a text length; lines of menus,
notices and the like have none. Sums over sliding windows of lines rise sharply where the main text
begins and fall to nothing where it ends. In the container of such a rise everything from its first
line to its last one with text of its own is kept, furniture aside.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from functools import lru_cache

WINDOW = 3  # lines in a window
SURGE = 86  # characters in a window that begin a main text

# Element names and the words in class, id and role that mark page furniture.
BLOCKS = frozenset(
    "address article aside blockquote body br button caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav "
    "ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title svg iframe object select head".split())
FURNITURE = frozenset("nav aside footer form menu dialog button".split())
MAIN = frozenset(("article", "main"))
GROUPS = frozenset("article main section div td center".split())  # may contain a main text
LAYOUT = frozenset(
    "nav navbar navigation menu breadcrumb breadcrumbs sidebar side-bar aside complementary "
    "footer contentinfo masthead site-header page-header banner topbar toolbar "
    "share sharing social related recommended pagination pager widget search searchbox form".split()
)
#: Marks of texts by others or beside the page: however long, they are not its main text.
OTHERS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion "
    "cookie cookies consent gdpr notice popup modal overlay newsletter subscribe signup login "
    "comment comments commentlist comment-list disqus replies reply respond".split()
)
#: Words that may follow a mark and leave it one (ad-slot, related-posts), as numbers may.
HOLDERS = frozenset(
    "area author bar block body bottom box button buttons center column container content desktop group header "
    "heading icon icons inner item items label left link links list main menu meta mobile module outer panel post "
    "posts primary right row secondary section slot thread title top unit widget widgets wrap wrapper".split()
)
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Words of class that describe a page and not the element's part in it (has-sidebar, comments-open).
STATE = re.compile(
    r"(?:is|layout)[-_]|(?:.*[-_])?(?:has|no|with|without)[-_]|.*[-_](?:open|closed|enabled|disabled)$", re.I
)
HIDDEN = re.compile(r"(?<![\w-])(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
NUMBER = re.compile(r"\d+(?:x\d+)?")
#: What kind of furniture an element is. LAID and OTHER are by marks; see ``reopened``.
NO, SURE, LAID, OTHER = range(4)


@lru_cache(1 << 16)
def mark(word: str, first: bool) -> int:
    """LAID or OTHER if a class, id or role word as a whole is a mark, else NO.

    A mark may be the last part of the word (cookie-notice) unless ``first`` is asked for, or its first
    part with only HOLDERS after it (ad-slot). A widget is what page builders call any block, so it is
    not a mark as a last part.
    """
    if STATE.match(word):
        return NO
    parts = [x for x in re.split(r"[^a-z0-9]+", word.lower()) if x and not NUMBER.fullmatch(x)]
    for n in (1, 2):
        begin, end = "-".join(parts[:n]), "-".join(parts[-n:])
        if all(x in HOLDERS for x in parts[n:]) and (begin in LAYOUT or begin in OTHERS):
            return LAID if begin in LAYOUT else OTHER
        if not first and end != "widget" and (end in LAYOUT or end in OTHERS):
            return LAID if end in LAYOUT else OTHER
    return NO


def furniture_kind(name: str, attributes: str, in_main: bool) -> int:
    """Whether an element is page furniture by name or marks, and how sure that is.

    A header in the main text is kept. An article or main element is furniture only if a word of its
    marks begins like one. Hidden is what has the attribute of that name or a style that hides it.
    """
    kind = LAID if name == "form" else SURE if name in FURNITURE or (name == "header" and not in_main) else NO
    if kind == SURE or len(attributes) < 2 or name in ("html", "body"):
        return kind
    values: dict[str, str] = {}
    for key, *value in ATTRIBUTE.findall(attributes):
        values.setdefault(key.lower(), "".join(value))
    if values.get("hidden", "false").lower() != "false" or HIDDEN.search(values.get("style", "")):
        return SURE
    words = (w for key in ("class", "id", "role") for w in values.get(key, "").split())
    return max(kind, *(mark(w, name in MAIN) for w in words), NO)


Line = tuple[str, int, bool, int]


def lines_of(page: str) -> tuple[list[Line], list[int]]:
    """See ``read_lines``; marked blocks that are the page's main text are read as others are."""
    lines, parents, again = read_lines(page, frozenset())
    return read_lines(page, again)[:2] if again else (lines, parents)


def reopened(marked: list[tuple[int, int, int]], total: int, alone: bool) -> frozenset[int]:
    """Places of the marked blocks that are no furniture, of ``(place, kind, unlinked text)``.

    They hold most of the page's unlinked ``total``; with marks of OTHERS they hold all of it, and are
    ``alone``: no other line is left.
    """
    most = {LAID: total // 2 + 1, OTHER: total if alone else total + 1}
    return frozenset(at for at, kind, held in marked if held and held >= most[kind])


def read_lines(page: str, opened: frozenset[int]) -> tuple[list[Line], list[int], frozenset[int]]:
    """``(text, length, declared, group)`` of each line that is not furniture, in page order.

    The length leaves out link texts. ``declared``: inside an article or main element. ``group``: the
    innermost of GROUPS around it, 0 if none; the second result has the group around each group. An
    empty furniture line comes as ``("", 0, False, 0)``, so that it takes part in the windows. Marked
    blocks at the places ``opened`` are no furniture; the third result has those that should be opened.
    """
    lines: list[Line] = []
    parents = [0]
    group = 0
    parts: list[str] = []
    linked = 0
    # Open elements that matter: whether each is furniture, its place, its kind, the text before it,
    # and the group around it.
    stack: list[tuple[str, bool, int, int, int, int]] = []
    marks: list[tuple[int, int, int]] = []
    still_open: Counter[str] = Counter()  # elements of the stack by name: a stray end tag costs no search
    unended: set[str] = set()  # raw elements that have no end tag from here on
    furniture = sure = main = links = total = 0
    seen_main = False
    at, end = 0, len(page)

    def close_line() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split())
        if text:
            lines.append((text, max(0, len(text) - linked), main > 0, group))
        parts.clear()
        linked = 0

    def leave(count: int) -> None:
        nonlocal furniture, sure, main, group
        group = stack[count][5] if count < len(stack) else group
        for name, marked, place, kind, before, _ in stack[count:]:
            still_open[name] -= 1
            furniture -= marked
            sure -= kind == SURE
            if kind > SURE:
                marks.append((place, kind, total - before))
            main -= name in MAIN and not marked
        del stack[count:]

    while at < end:
        found = TOKEN.search(page, at)
        stop = found.start() if found else end
        if stop > at and not sure and not links:
            total += len(page[at:stop].strip())
        if stop > at and not furniture:
            piece = page[at:stop]
            parts.append(piece)
            linked += len(piece) if links else 0
        if not found:
            break
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        closing, attributes = found[1], found[3]
        if name in RAW and not closing and not attributes.endswith("/>"):
            shut = None
            if name not in unended:
                shut = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            if shut is None:
                unended.add(name)
            if shut is None and name in ("head", "select", "object", "svg", "noscript", "template"):
                continue  # never closed: read on inside it
            at = shut.end() if shut else end
            parts.append(" ")
            continue
        if name == "a":
            links = max(0, links - 1) if closing else links + 1
        if name not in BLOCKS and name != "span":
            continue
        if name in BLOCKS:
            close_line()
            links = 0 if name != "br" else links
        if name in VOID:
            continue
        if closing:
            if still_open[name]:
                leave(next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name))
            continue
        if name == "p" and stack and stack[-1][0] == "p":
            leave(len(stack) - 1)  # a paragraph ends the one before
        kind = furniture_kind(name, attributes, main > 0)
        marked = kind != NO and found.start() not in opened
        if name in MAIN and furniture and not marked and not seen_main:
            leave(0)  # furniture that was never closed ends where the main text begins
        if marked and not furniture:
            close_line()
            lines.append(("", 0, False, 0))
        furniture += marked
        sure += kind == SURE
        main += name in MAIN and not marked
        seen_main |= main > 0
        stack.append((name, marked, found.start(), kind, total, group))
        still_open[name] += 1
        if name in GROUPS and not furniture:
            parents.append(group)
            group = len(parents) - 1
    close_line()
    leave(0)
    return lines, parents, reopened(marks, total, not any(text for text, *_ in lines))


def containers(lines: list[Line], parents: list[int]) -> tuple[list[int], list[int], list[int]]:
    """For each group its container, first line and last line with a length.

    A group of one line is a paragraph; its container is the next group around it that has more.
    """
    count = [0] * len(parents)
    first, last = [len(lines)] * len(parents), [-1] * len(parents)
    for i, (text, length, _, group) in enumerate(lines):
        count[group] += bool(text)
        if length:
            first[group], last[group] = min(first[group], i), i
    for group in range(len(parents) - 1, 0, -1):  # a group comes after the one around it
        around = parents[group]
        count[around] += count[group]
        first[around], last[around] = min(first[around], first[group]), max(last[around], last[group])
    nearest = [0] * len(parents)
    for group in range(1, len(parents)):
        nearest[group] = group if count[group] > 1 else nearest[parents[group]]
    return nearest, first, last


def main_text(page: str | None) -> str:
    """The main text: lines joined by one space, empty if there is none.

    If the page declares a main text (article, main) that holds the larger part of its unlinked text,
    every line inside is kept and none outside. Else a window of SURGE characters begins a main text,
    which reaches in both directions up to a line of furniture or a window without length, and beyond
    these from the first to the last line with a length in the container of the window. What is in no
    container but the page is kept from the first surge on. If one container fills a window of
    its own, surges in it and holds over two thirds of the unlinked text, only containers with such a window are
    main text: a notice or an imprint beside them goes, however long, whatever its name.
    """
    lines, parents = lines_of(page or "")
    inside = sum(n for _, n, d, _ in lines if d)
    if any(d for _, _, d, _ in lines) and 2 * inside >= sum(n for _, n, _, _ in lines):
        return " ".join(text for text, _, d, _ in lines if d)
    lengths = [n for _, n, _, _ in lines]
    nearest, first, last = containers(lines, parents)
    kept = [False] * len(lines)
    regions = set()
    held: Counter[int] = Counter()  # lengths of the containers that fill a window and surge in it
    begin = 0
    while begin < len(lines):
        stop = begin
        while stop < len(lines) and lengths[stop]:
            stop += 1
        # A window does not look past furniture.
        surges = [i for i in range(begin, stop) if sum(lengths[i : min(i + WINDOW, stop)]) >= SURGE]
        if surges:
            kept[begin:stop] = [True] * (stop - begin)
            regions.update(nearest[lines[i][3]] for i in surges)
        for i in surges:
            window = {nearest[lines[j][3]] for j in range(i, min(i + WINDOW, stop))}
            if len(window) == 1 and i + WINDOW <= stop:
                held[window.pop()] = 0
        begin = stop + 1
    around = [0] * len(parents)
    for group in range(1, len(parents)):
        around[group] = group if group in held else around[parents[group]]
    for _, length, _, group in lines:
        if around[group]:
            held[around[group]] += length
    main, most = max(held.items(), key=lambda item: item[1], default=(0, 0))
    if main and 3 * most > 2 * sum(lengths):
        # The windows rise and dive with this container: lines in no other that surges are beside it.
        regions = {region for region in held if region}
        kept = [False] * len(lines)
    if 0 in regions:
        first[0] = kept.index(True)
    if not regions:  # no window is long enough: the page is short, all its own text is the text
        regions.add(0)
    at = 0
    for low, high in sorted((first[r], last[r]) for r in regions):  # one holds another or is apart
        for i in range(max(low, at), high + 1):
            kept[i] = True
        at = max(at, high + 1)
    return " ".join(text for (text, _, _, _), k in zip(lines, kept) if k and text)
