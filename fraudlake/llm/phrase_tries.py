"""Words and pieces of texts as arrays, tallies of hashed phrases, and double-array tries of phrases."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa

from fraudlake.llm.word_grams import LOWER, MIX, STEP, Hasher, mixed, text_parts

LONGEST = 4
_codes = np.arange(256)
# What ends a piece, and what else ends a word.
ENDS_PIECE = np.isin(_codes, [ord(c) for c in ".,;:!?\n\v\f\r"])
IN_WORD = ~(ENDS_PIECE | np.isin(_codes, [ord(" "), ord("\t")]))
NONE, TOP_BIT = np.uint64(0), np.uint64(1 << 63)
HASHED = 1 << 18  # bytes whose words are hashed at once, as each takes several numbers
COMPARED = 1 << 15  # words whose bytes are compared at once
GAPS = 64  # looked at for a node of several children


def text_hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little")


class PieceWords:
    """Words of consecutive texts: bytes, start and end, a hash that is never 0, and the piece."""

    def __init__(self, low: np.ndarray, offsets: np.ndarray, hasher: Hasher, seed: int):
        self.low = low
        inside = IN_WORD[low]
        before = np.concatenate(([False], inside[:-1]))
        after = np.concatenate((inside[1:], [False]))
        before[offsets[:-1][offsets[:-1] < len(low)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        first = np.searchsorted(self.starts, offsets)
        self.owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        self.piece = np.cumsum(ENDS_PIECE[low], dtype=np.int32)[self.starts] + self.owner
        hashes, at = [np.zeros(0, np.uint64)], 0
        while at < len(self.starts):
            base = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, base + HASHED, side="right")))
            hashes.append(hasher.hash(low[base : self.ends[to - 1]], self.starts[at:to] - base, self.ends[at:to] - base))
            at = to
        self.hashes = mixed(np.concatenate(hashes) + np.uint64(seed * MIX % (1 << 64))) | np.uint64(1)

    def strings(self, numbers: np.ndarray) -> pa.Array:
        sizes = (self.ends - self.starts)[numbers]
        ends = np.cumsum(sizes)
        steps = np.arange(sizes.sum()) - np.repeat(ends - sizes, sizes)
        data = self.low[np.repeat(self.starts[numbers], sizes) + steps]
        offsets = np.concatenate(([0], ends)).astype(np.int32)
        return pa.StringArray.from_buffers(len(numbers), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes()))

    def differ(self, others: np.ndarray) -> np.ndarray:
        """Numbers of the words whose bytes are not those of the word ``others`` has for them."""
        sizes = self.ends - self.starts
        found = sizes != sizes[others]
        at = np.flatnonzero(~found & (others != np.arange(len(others))))
        size = sizes[at]
        for a in range(0, len(at), COMPARED):  # in parts, as each byte takes several numbers
            some, n = at[a : a + COMPARED], size[a : a + COMPARED]
            steps = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            unequal = self.low[np.repeat(self.starts[some], n) + steps] != self.low[np.repeat(self.starts[others[some]], n) + steps]
            found[np.repeat(some, n)[unequal]] = True
        return np.flatnonzero(found)

    def grams(self, k: int, salt: np.ndarray) -> np.ndarray:
        """Hash of the ``k`` words from each word on, 0 where they are not of one piece.

        ``salt`` is a number per text that keeps the phrases of different languages apart.
        """
        out = np.zeros(len(self.hashes), np.uint64)
        n = len(self.hashes) - k + 1
        if n > 0:
            h = salt[self.owner[:n]] + np.uint64(k)
            for j in range(k):
                h = h * np.uint64(STEP) + self.hashes[j : j + n]
            out[:n] = np.where(self.piece[:n] == self.piece[k - 1 :], mixed(h) | TOP_BIT, NONE)
        return out


def piece_batches(batch: pa.RecordBatch, hasher: Hasher, seed: int) -> Iterator[tuple[list[str], np.ndarray, PieceWords]]:
    """``(languages, salts, words)`` of runs of the rows of ``(lang, text)``."""
    for a, b, data, offsets in text_parts(batch.column("text")):
        langs = batch.column("lang").slice(a, b - a).to_pylist()
        salt_of = {lang: text_hash(lang) for lang in set(langs)}
        yield langs, np.array([salt_of[lang] for lang in langs], np.uint64), PieceWords(LOWER[data], offsets, hasher, seed)


class Tally:
    """Counts of hashes, cut at ``most``: they say whether a sum reaches it, and fit into a byte."""

    def __init__(self, most: int):
        self.most = most
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[np.ndarray] = []

    def add(self, keys: np.ndarray) -> int:
        """Takes keys; the number of different ones held, without those that wait to be merged."""
        self.waiting.append(keys)
        if sum(map(len, self.waiting)) > max(len(self.keys), 1 << 20):
            self.merge()
        return len(self.keys)

    def merge(self) -> None:
        weights = np.concatenate([self.counts, np.ones(sum(map(len, self.waiting)), np.int64)])
        self.keys, self.counts = summed(np.concatenate([self.keys, *self.waiting]), weights)
        self.counts = np.minimum(self.counts, self.most)
        self.waiting = []


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their counts."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts[:0]


def distinct_rows(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows of a matrix and the sums of their counts."""
    if len(rows) < 2:
        return rows, counts
    order = np.lexsort(rows.T)
    rows = rows[order]
    first = np.flatnonzero(np.concatenate(([True], (rows[1:] != rows[:-1]).any(axis=1))))
    return rows[first], np.add.reduceat(counts[order], first)


def row_hashes(rows: np.ndarray) -> np.ndarray:
    """A hash of every row of a matrix."""
    out = np.full(len(rows), rows.shape[1], np.uint64)
    for column in rows.T:
        out = out * np.uint64(STEP) + column
    return mixed(out)


class PhraseTrie:
    """A double array of phrases: from cell ``s`` the symbol ``c`` leads to ``base[s] + c`` if that cell's
    ``check`` is ``s``. A word is the place of its hash in ``words``, written with ``digits`` symbols of 8
    bits, so that no cell has more than 256 children. A phrase begins at the cell of its language in
    ``roots``; ``accepts`` numbers the phrases, -1 for inner cells."""

    ARRAYS = ("words", "base", "check", "accepts")

    def __init__(self, langs: Sequence[str], arrays: Sequence[np.ndarray]):
        self.roots = {lang: i for i, lang in enumerate(langs)}
        self.words, self.base, self.check, self.accepts = arrays
        self.digits = max(1, -(-int(len(self.words) - 1).bit_length() // 8))

    @classmethod
    def built(cls, langs: Sequence[str], phrases: Sequence[Sequence[int]]) -> PhraseTrie:
        rows = [np.array(p, np.int64).view(np.uint64) for p in phrases]
        words = np.unique(np.concatenate(rows)) if rows else np.zeros(0, np.uint64)
        names = sorted(set(langs))
        empty = np.zeros(0, np.int32)
        digits = cls(names, [words, empty, empty, empty]).digits
        symbols = words_symbols(len(words), digits)
        root = {lang: i for i, lang in enumerate(names)}
        children: dict[int, dict[int, int]] = {}
        accepts = [-1] * len(names)
        for number, (lang, row) in enumerate(zip(langs, rows)):
            node = root[lang]
            for symbol in symbols[np.searchsorted(words, row)].ravel().tolist():
                to = children.setdefault(node, {}).setdefault(symbol, len(accepts))
                if to == len(accepts):
                    accepts.append(-1)
                node = to
            accepts[node] = number
        return cls(names, [words, *placed(children, accepts, len(names))])

    @classmethod
    def of_bytes(cls, langs: Sequence[str], raw: Sequence[bytes]) -> PhraseTrie:
        kinds = {"words": np.uint64}
        return cls(langs, [np.frombuffer(r, kinds.get(n, np.int32)) for n, r in zip(cls.ARRAYS, raw)])

    def to_bytes(self) -> list[bytes]:
        return [getattr(self, name).tobytes() for name in self.ARRAYS]

    def count(self, words: PieceWords, langs: Sequence[str], counts: np.ndarray) -> None:
        """Adds the occurrences of every phrase to ``counts``: all positions go down a level at once."""
        if not len(self.words):
            return
        code, known = self.codes(words.hashes)
        root = np.array([self.roots.get(lang, -1) for lang in langs], np.int64)[words.owner]
        at = np.flatnonzero(known & (root >= 0))
        state = root[at]
        for depth in range(LONGEST):
            if depth:
                inside = at + depth < len(code)
                at, state = at[inside], state[inside]
                good = known[at + depth] & (words.piece[at] == words.piece[at + depth])
                at, state = at[good], state[good]
            at, state = self.down(at, state, code[at + depth])
            found = self.accepts[state]
            counts += np.bincount(found[found >= 0], minlength=len(counts))

    def add(self, lang: str, rows: np.ndarray, times: np.ndarray, counts: np.ndarray) -> None:
        """Adds ``times`` of every row, a phrase as hashes, to the count of its phrase: all rows go down a level at once."""
        if not len(self.words):
            return
        code, known = self.codes(rows)
        at = np.flatnonzero(known.all(axis=1) & (lang in self.roots))
        state = np.full(len(at), self.roots.get(lang, -1), np.int64)
        for depth in range(rows.shape[1]):
            at, state = self.down(at, state, code[at, depth])
        found = self.accepts[state]
        np.add.at(counts, found[found >= 0], times[at[found >= 0]])

    def codes(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The places of words, and whether they are there."""
        code = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        return code, self.words[code] == hashes

    def down(self, at: np.ndarray, state: np.ndarray, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those of ``at`` whose state goes on by their word, and the states that it leads to."""
        for shift in range(8 * (self.digits - 1), -1, -8):
            to = self.base[state] + (code >> shift & 255)
            good = self.check[to] == state
            at, state, code = at[good], to[good], code[good]
        return at, state


def words_symbols(n: int, digits: int) -> np.ndarray:
    """The symbols of the words 0 to ``n - 1``, a row each."""
    shifts = 8 * np.arange(digits - 1, -1, -1)
    return (np.arange(n)[:, None] >> shifts & 255).astype(np.int64)


def placed(children: dict[int, dict[int, int]], accepts: list[int], roots: int) -> tuple[np.ndarray, ...]:
    """The cells of a double array: ``base``, ``check`` and ``accepts``.

    Level by level, nodes with most children first: their cells go into the first of a few recent
    gaps that has room for all of them, or behind the last cell in use. One child fits into any gap.
    """
    size = 512 + roots + 2 * len(accepts)
    base, check, marks = (np.full(size, v, np.int32) for v in (0, -1, -1))
    check[:roots] = -2  # taken, and no cell's child
    used = roots + 256
    gaps = list(range(used - 1, roots + 255, -1))
    level = list(zip(range(roots), range(roots)))  # (node, cell)
    while level:
        level = [at for at in level if at[0] in children]
        level.sort(key=lambda at: -len(children[at[0]]))
        following = []
        for node, cell in level:
            kids = sorted(children.pop(node).items())
            symbols = np.array([c for c, _ in kids], np.int64)
            first = None
            if len(kids) == 1:
                while gaps and first is None:
                    gap = gaps.pop()
                    first = gap if check[gap] == -1 else None
            elif gaps:
                tries = np.array(gaps[-GAPS:], np.int64)
                free = (check[tries[:, None] + (symbols - symbols[0])] == -1).all(axis=1)
                first = int(tries[free.argmax()]) if free.any() else None
            if first is None:
                first = used
            at = first + symbols - symbols[0]
            if at[-1] + 512 > len(check):
                more = len(check)
                base, check, marks = (np.concatenate((a, np.full(more, v, np.int32))) for a, v in ((base, 0), (check, -1), (marks, -1)))
            base[cell] = first - symbols[0]
            check[at] = cell
            if at[-1] >= used:
                taken = set(at.tolist())
                gaps += [i for i in range(used, int(at[-1])) if i not in taken]
                used = int(at[-1]) + 1
            for (_, to), own in zip(kids, at.tolist()):
                marks[own] = accepts[to]
                following.append((to, own))
        level = following
    return base[: used + 256], check[: used + 256], marks[: used + 256]
