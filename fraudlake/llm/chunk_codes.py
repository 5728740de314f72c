"""Content-defined chunks of texts, their token codes, and the repair of the joins between chunks.

A code is a token id; the first token of a pre-token carries the flag FIRST, so that the places where
pre-tokens begin are known without the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np

from fraudlake.llm.merging import KNOWN, NEVER, Merger, printable_bytes

WINDOW_STEPS = 4  # doublings: the hash at a character covers the 16 characters up to it
CHUNK_LEAST, CHUNK_MEAN, CHUNK_MOST = 256, 1024, 1 << 14
STEP = np.uint64(0x9E3779B97F4A7C15)
FIRST = np.uint32(1 << 31)
ID = np.uint32(FIRST - 1)
AHEAD = 8  # bytes: the pattern looks at most two characters beyond the end of a pre-token
TOKENS = 16  # tokens on each side that a join is first looked at with
WIDER = 8
EMPTY = np.zeros(0, np.uint32)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def cut_marks(codes: np.ndarray) -> np.ndarray:
    """Places after the characters at which the rolling hash asks for a cut, one in CHUNK_MEAN of all."""
    h = (codes.astype(np.uint64) + np.uint64(1)) * STEP
    h ^= h >> np.uint64(32)
    h *= STEP
    for i in range(WINDOW_STEPS):
        width = 1 << i
        wider = h.copy()
        wider[width:] += h[:-width] << np.uint64(width)
        h = wider
    h *= STEP
    return np.flatnonzero((h >> np.uint64(40)) % np.uint64(CHUNK_MEAN) == 0) + 1


def chunk_bounds(codes: np.ndarray, offsets: Sequence[int]) -> list[list[int]]:
    """Per text (between two offsets) the places of its cuts, both ends included.

    Chunks have CHUNK_LEAST to CHUNK_MOST characters, the last one of a text any number. A cut
    depends on the characters before it alone, so equal passages have equal chunks after their first cut.
    """
    marks = cut_marks(codes)
    inside = np.searchsorted(marks, offsets)
    found = []
    for begin, end, low, high in zip(offsets, offsets[1:], inside, inside[1:]):
        bounds = [begin]
        for mark in [*marks[low:high].tolist(), end]:
            while mark - bounds[-1] > CHUNK_MOST:
                bounds.append(bounds[-1] + CHUNK_MOST)
            if CHUNK_LEAST <= mark - bounds[-1] and mark < end:
                bounds.append(mark)
        if bounds[-1] < end:
            bounds.append(end)
        found.append(bounds)
    return found


def chunks_of(texts: Sequence[str]) -> list[list[str]]:
    """The chunks of each text; an empty text has none."""
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).tolist()
    bounds = chunk_bounds(code_points("".join(texts)), offsets)
    return [
        [text[a - at[0] : b - at[0]] for a, b in zip(at, at[1:])] for text, at in zip(texts, bounds)
    ]


def chunk_key(chunk: str) -> tuple[int, int]:
    """128 bits of a digest, as two signed numbers."""
    digest = hashlib.blake2b(chunk.encode(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


class Coder(Merger):
    """Codes of texts as the tokenizer described by ``config`` gives them, and back."""

    def __init__(self, config: str):
        super().__init__(config)
        byte_of = {c: b for b, c in enumerate(printable_bytes())}
        tokens = {i: bytes(byte_of[c] for c in t) for t, i in self.spec["model"]["vocab"].items()}
        self.special_ids = {t["content"]: t["id"] for t in self.spec.get("added_tokens", [])}
        tokens.update((i, t.encode()) for t, i in self.special_ids.items())
        ordered = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        self.sizes = np.array([len(t) for t in ordered], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(ordered), np.uint8)
        self.guard = AHEAD + max([len(t.encode()) for t in self.special_ids], default=0)

    def merged_ids(self, tokens: Sequence[bytes]) -> list[bytes]:
        """The ids that each (non-empty) pre-token is merged to, the first one flagged, as bytes.

        All sequences lie in one array; in every step each merges its lowest-ranked pair.
        """
        lengths = np.array([len(t) for t in tokens], np.int64)
        ids = self.byte_ids[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), lengths)
        rank = np.full(len(ids), NEVER, np.int32)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self.rank_of(ids[inner], ids[inner + 1])
        ended: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            begins = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            lowest = np.repeat(np.minimum.reduceat(rank, begins), np.diff(np.append(begins, len(ids))))
            live = lowest != NEVER
            if not live.all():
                ended.append((owner[~live], ids[~live]))
                ids, owner, rank, lowest = ids[live], owner[live], rank[live], lowest[live]
                if not len(ids):
                    break
            place = np.flatnonzero(rank == lowest)
            run = np.flatnonzero(np.concatenate(([True], np.diff(place) != 1)))
            offset = np.arange(len(place)) - np.repeat(run, np.diff(np.append(run, len(place))))
            place = place[offset % 2 == 0]
            ids[place] = self.made[rank[place]]
            stays = np.ones(len(ids), bool)
            stays[place + 1] = False
            rank[place] = rank[place + 1]
            moved = np.cumsum(stays)[place] - 1
            ids, owner, rank = ids[stays], owner[stays], rank[stays]
            for at in (moved, moved[moved > 0] - 1):
                at = at[at + 1 < len(ids)]
                same = owner[at] == owner[at + 1]
                rank[at] = np.where(same, self.rank_of(ids[at], ids[at + 1]), NEVER)
        owners = np.concatenate([o for o, _ in ended])
        order = np.argsort(owners, kind="stable")
        flat = np.concatenate([i for _, i in ended])[order].astype(np.uint32)
        begins = np.searchsorted(owners[order], np.arange(len(tokens) + 1))
        flat[begins[:-1]] |= FIRST
        raw, at = flat.tobytes(), (4 * begins).tolist()
        return [raw[a:b] for a, b in zip(at, at[1:])]

    def keep(self, names: list[str], pieces: list[list[str]]) -> None:
        wanted = set().union(*pieces)
        if len(self.pieces_known) > KNOWN:
            self.pieces_known.clear()
        new = list(wanted.difference(self.pieces_known))
        if new:
            self.pieces_known.update(zip(new, self.merged_ids([p.encode() for p in new])))
        of = self.pieces_known.__getitem__
        self.words_known.update((n, b"".join(map(of, found))) for n, found in zip(names, pieces))

    def encode(self, texts: Sequence[str]) -> list[np.ndarray]:
        """The codes of each text; a special string inside a text is one token."""
        cut: list[list[list[str]]] = []
        between: list[list[bytes]] = []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            cut.append([self.words(part) for part in parts])
            found = self.special.findall(text) if len(parts) > 1 else []
            between.append([np.uint32(self.special_ids[s] | int(FIRST)).tobytes() for s in found])
        wanted = {w for parts in cut for words in parts for w in words}
        if len(self.words_known) > KNOWN:
            self.words_known.clear()
        self.learn(wanted.difference(self.words_known))
        of = self.words_known.__getitem__
        codes = []
        for parts, specials in zip(cut, between):
            raw = [b"".join(map(of, words)) for words in parts]
            for i, special in enumerate(specials):
                raw[i] += special
            codes.append(np.frombuffer(b"".join(raw), np.uint32))
        return codes

    def decode(self, codes: np.ndarray) -> bytes:
        ids = (codes & ID).astype(np.int64)
        sizes = self.sizes[ids]
        places = np.repeat(self.starts[ids] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        return self.data[places].tobytes()

    def begins(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pre-tokens begin: numbers of their first tokens, and their places in bytes."""
        sizes = self.sizes[codes & ID]
        first = (codes >= FIRST).nonzero()[0]
        return first, (sizes.cumsum() - sizes)[first]

    def joined(self, texts: Sequence[Sequence[np.ndarray]]) -> list[np.ndarray]:
        """The codes of each text, given the codes of its consecutive parts.

        The codes of the text up to a join are those of its own, so the pre-tokens at its end that
        other characters after them could have changed are re-encoded with the head of the next
        part. Matching goes from left to right, so as soon as the re-encoded window and the part
        begin a pre-token at the same place, far enough from the window's end, they agree from there
        on: the rest of the part is taken over. Until then the window is made wider. The first windows
        of all joins are encoded together.
        """
        texts = [[p for p in parts if len(p)] for parts in texts]
        joins = [(left, right) for parts in texts for left, right in zip(parts, parts[1:])]
        windows = []
        for left, right in joins:
            keep = self.settled(left)
            windows.append((keep, self.window(left[keep:], self.head(right, TOKENS)) if keep else ""))
        ready = iter(zip(windows, self.encode([w for _, w in windows])))
        return [self.joined_parts(parts, ready) for parts in texts]

    def joined_parts(self, parts: Sequence[np.ndarray], ready: Iterator) -> np.ndarray:
        if not parts:
            return EMPTY
        done: list[np.ndarray] = []
        tail, begin = parts[0], 0
        for right, ((keep, _), again) in zip(parts[1:], ready):
            if keep > begin and len(tail):  # the part before still ends as it did
                keep -= begin
            else:
                again, keep = None, self.settled(tail)
                while keep == 0 and done:
                    tail = np.concatenate((done.pop(), tail))
                    keep = self.settled(tail)
            begin, again = self.repaired(tail[keep:], right, again)
            done += [tail[:keep], again]
            tail = right[begin:]
        return np.concatenate([*done, tail])

    def settled(self, codes: np.ndarray) -> int:
        """The last token that begins a pre-token whatever follows the text; 0 if none is known."""
        n = TOKENS
        while True:
            part = codes[-n:]
            to_end = self.sizes[part & ID][::-1].cumsum()[::-1]
            good = ((part >= FIRST) & (to_end >= self.guard)).nonzero()[0]
            if len(good):
                return len(codes) - len(part) + int(good[-1])
            if n >= len(codes):
                return 0
            n *= WIDER

    def head(self, codes: np.ndarray, n: int) -> np.ndarray:
        """The first pre-tokens, about ``n`` tokens; none if the first one is longer than that."""
        return codes if n >= len(codes) else codes[: (codes[: n + 1] >= FIRST).nonzero()[0][-1]]

    def window(self, left: np.ndarray, head: np.ndarray) -> str:
        return self.decode(np.concatenate((left, head))).decode()

    def repaired(self, left: np.ndarray, right: np.ndarray, again: np.ndarray | None) -> tuple[int, np.ndarray]:
        """``(token of right, codes)``: the codes that stand for ``left`` and ``right`` up to that token.

        ``again`` is the first window's encoding, if it is known.
        """
        base = int(self.sizes[left & ID].sum())
        n = TOKENS
        while True:
            head, whole = self.head(right, n), n >= len(right)
            n *= WIDER
            if not len(head):
                again = None
                continue
            if again is None:
                again = self.encode([self.window(left, head)])[0]
            first, places = self.begins(head)
            end = base + int(self.sizes[head & ID].sum())
            sure = end if whole else end - self.guard
            mine, at = self.begins(again)
            theirs = np.minimum(places.searchsorted(at - base), len(places) - 1)
            both = ((places[theirs] + base == at) & (at <= sure)).nonzero()[0]
            if len(both):
                i, to = int(mine[both[0]]), int(mine[both[-1]])
                j = int(first[theirs[both[0]]])
                if np.array_equal(again[i:to], right[j : j + to - i]):
                    return j, again[:i]
            if whole:
                return len(right), again
            again = None

    def result(self, codes: np.ndarray) -> tuple[int, str, str]:
        """Number of tokens, digest of the ids, digest of the decoded text."""
        ids = (codes & ID).astype("<u4").tobytes()
        text = self.decode(codes).decode("utf-8", "replace").encode()
        return len(codes), hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest()
