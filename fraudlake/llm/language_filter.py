"""Bit-sliced Bloom filters of n-grams: one look-up returns all languages that contain an n-gram."""

from __future__ import annotations

import numpy as np

from fraudlake.llm.word_grams import LOWER, MIX, STEP, mixed

LENGTHS = (3, 5)  # bytes
HASHES = 2

_codes = np.arange(256, dtype=np.uint8)
IS_LETTER = ((_codes >= 97) & (_codes <= 122)) | (_codes >= 128)


def letters(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased bytes in which every run of other characters is one space, and each byte's text.

    A space stands before and after every text, so words are seen with their ends.
    """
    n = len(offsets) - 1
    low = LOWER[data]
    low = np.where(IS_LETTER[low], low, np.uint8(32))
    out = np.full(len(low) + 2 * n, 32, np.uint8)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    out[np.arange(len(low)) + 2 * owner + 1] = low
    owner = np.repeat(np.arange(n), np.diff(offsets) + 2)
    again = (out[1:] == 32) & (out[:-1] == 32) & (owner[1:] == owner[:-1])
    keep = np.concatenate((np.ones(min(1, len(out)), bool), ~again))
    return out[keep], owner[keep]


def grams(low: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams inside one text as numbers (their bytes, and the length on top), and their texts."""
    n = len(low) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    packed = np.full(n, length, np.uint64)
    for j in range(length):
        packed = packed << np.uint64(8) | low[j : j + n]
    whole = owner[:n] == owner[length - 1 :]
    return packed[whole], owner[:n][whole]


class LanguageFilter:
    """``slices[i][slot]``: a byte with a bit for each of the languages 8i to 8i + 7."""

    def __init__(self, languages: list[str], bits: int):
        self.languages, self.bits = languages, bits
        self.slices = np.zeros(((len(languages) + 7) // 8, 1 << bits), np.uint8)

    def slots(self, packed: np.ndarray) -> list[np.ndarray]:
        h = mixed(packed * np.uint64(STEP))
        shift = np.uint64(64 - self.bits)
        return [((h * np.uint64(MIX + 2 * i)) >> shift).astype(np.int64) for i in range(HASHES)]

    def add(self, packed: np.ndarray, language: np.ndarray) -> None:
        for slot in self.slots(packed):
            for i in range(len(self.slices)):
                inside = language // 8 == i
                np.bitwise_or.at(self.slices[i], slot[inside], (1 << language[inside] % 8).astype(np.uint8))

    def false_rates(self) -> np.ndarray:
        """For each language, how often an n-gram that it lacks is found all the same."""
        filled = [(s >> b & 1).mean() for s in self.slices for b in range(8)]
        return np.array(filled[: len(self.languages)]) ** HASHES

    def hits(self, packed: np.ndarray, owner: np.ndarray, texts: int) -> np.ndarray:
        """``(texts, languages)``: n-grams of each text that each language seems to contain."""
        slots = self.slots(packed)
        out = []
        for s in self.slices:
            found = s[slots[0]]
            for slot in slots[1:]:
                found = found & s[slot]
            masks = np.bincount(owner * 256 + found, minlength=256 * texts).reshape(texts, 256)
            out.append(masks @ (np.arange(256)[:, None] >> np.arange(8) & 1))
        return np.concatenate(out, axis=1)[:, : len(self.languages)] if out else np.zeros((texts, 0))

    def shares(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """``(texts, languages)``: share of a text's n-grams in each language.

        False positives are taken off: of n n-grams h are found; with a false rate f, (h - nf) / (1 - f)
        are there in expectation.
        """
        texts = len(offsets) - 1
        low, owner = letters(data, offsets)
        hits, seen = np.zeros((texts, len(self.languages))), np.zeros(texts)
        for length in LENGTHS:
            packed, of = grams(low, owner, length)
            hits += self.hits(packed, of, texts)
            seen += np.bincount(of, minlength=texts)
        rate = self.false_rates()
        real = (hits - seen[:, None] * rate) / np.maximum(1e-9, 1 - rate)
        return np.clip(real / np.maximum(1, seen)[:, None], 0, 1)
