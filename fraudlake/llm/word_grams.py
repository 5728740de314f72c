"""Words and word n-grams of many texts at once, as arrays over their UTF-8 bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

PART = 1 << 21  # bytes of text hashed at once
STEP = 0x9E3779B97F4A7C15
MIX = 0xBF58476D1CE4E5B9

_codes = np.arange(256, dtype=np.uint8)
LOWER = np.where((_codes >= 65) & (_codes <= 90), _codes + 32, _codes).astype(np.uint8)
# After lower-casing: digits, letters and every byte of a character beyond ASCII.
IN_WORD = ((_codes >= 48) & (_codes <= 57)) | ((_codes >= 97) & (_codes <= 122)) | (_codes >= 128)


def powers(n: int, base: int) -> np.ndarray:
    """base^0 ... base^(n-1) modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


class Hasher:
    """Polynomial hashes of words: equal words have equal hashes wherever they stand."""

    def __init__(self) -> None:
        self.size = 0

    def grow(self, n: int) -> None:
        if n > self.size:
            self.size = max(n, PART)
            self.up = powers(self.size, STEP)
            self.down = powers(self.size, pow(STEP, -1, 1 << 64))

    def hash(self, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self.grow(len(low))
        sums = np.zeros(len(low) + 1, np.uint64)
        np.cumsum((low.astype(np.uint64) + np.uint64(1)) * self.up[: len(low)], out=sums[1:])
        return mixed((sums[ends] - sums[starts]) * self.down[starts])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(MIX)
    return h ^ (h >> np.uint64(29))


class Words:
    """Words of consecutive texts: bytes, start and end of each word, its hash and its text's number."""

    def __init__(self, low: np.ndarray, offsets: np.ndarray, hasher: Hasher):
        self.low = low
        inside = IN_WORD[low]
        before = np.concatenate(([False], inside[:-1]))
        after = np.concatenate((inside[1:], [False]))
        before[offsets[:-1][offsets[:-1] < len(low)]] = False
        after[offsets[1:][offsets[1:] > 0] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(first)
        self.owner = np.repeat(np.arange(len(self.counts)), self.counts)
        self.first = first[:-1]
        # In parts cut between words, so that the arrays of 8 bytes per byte stay small.
        hashes = []
        at = 0
        while at < len(self.starts):
            base = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, base + PART, side="right")))
            hashes.append(hasher.hash(low[base : self.ends[to - 1]], self.starts[at:to] - base, self.ends[at:to] - base))
            at = to
        self.hashes = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)

    def text(self, a: int, b: int) -> str:
        """Words a to b (without b), joined by a space."""
        return " ".join(self.low[self.starts[i] : self.ends[i]].tobytes().decode() for i in range(a, b))

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k words from each word on; those that would leave the text are meaningless."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        out = np.full(n, k, np.uint64)
        for j in range(k):
            out = out * np.uint64(STEP) + self.hashes[j : j + n]
        return mixed(out)

    def whole(self, k: int) -> np.ndarray:
        """Whether the k words from each word on are of one text."""
        n = len(self.hashes) - k + 1
        return self.owner[:n] == self.owner[k - 1 :] if n > 0 else np.zeros(0, bool)


def text_parts(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(from, to, bytes, offsets)`` for runs of texts of about PART bytes; null is empty.

    A longer text is a run of its own.
    """
    raw = texts.cast(pa.large_binary())
    if raw.null_count:
        raw = raw.fill_null(b"")
    offsets = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    data = np.frombuffer(raw.buffers()[2], np.uint8) if raw.buffers()[2] else np.zeros(0, np.uint8)
    at = 0
    while at < len(raw):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PART, side="right")) - 1)
        yield at, to, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def word_batches(texts: pa.Array, hasher: Hasher) -> Iterator[tuple[int, int, Words]]:
    for a, b, data, offsets in text_parts(texts):
        yield a, b, Words(LOWER[data], offsets, hasher)


def winnowed(words: Words, k: int, window: int) -> np.ndarray:
    """Word positions whose k-gram is the smallest of some ``window`` consecutive ones, ties to the right.

    Two texts that share ``window + k - 1`` words in a row keep a k-gram at the same place in them.
    """
    span = window + k - 1
    full = words.whole(span)
    if not len(full):
        return np.zeros(0, np.int64)
    grams = words.grams(k)
    n = len(full)
    best, at = grams[window - 1 : window - 1 + n].copy(), np.full(n, window - 1, np.int64)
    for j in range(window - 2, -1, -1):
        smaller = grams[j : j + n] < best
        best = np.where(smaller, grams[j : j + n], best)
        at[smaller] = j
    return np.unique((np.arange(n) + at)[full])
