"""Byte-level BPE token counts by rank-synchronous merging of ragged arrays."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

import numpy as np
import regex

# White space and the pre-token pattern of the byte-level vocabulary.
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PRE_TOKENS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{WHITE}\p{{L}}\p{{N}}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
)
NEVER = np.iinfo(np.int32).max
KNOWN = 1 << 19  # words whose counts are kept
CHUNK = 1 << 20  # bytes merged at once


def printable_bytes() -> list[str]:
    """The character that stands for each byte in the vocabulary file.

    Rule: printable Latin-1 characters stand for themselves, the others for U+0100 and on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    return [chr(others.get(b, b)) for b in range(256)]


def spread(keys: np.ndarray, size: int) -> np.ndarray:
    """Slot numbers: the upper bits of a product with an odd constant."""
    mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(64 - (size.bit_length() - 1))).astype(np.int64)


class Merger:
    """Counts tokens of texts as the tokenizer described by ``config`` (the text of its JSON file)."""

    def __init__(self, config: str):
        self.spec = spec = json.loads(config)
        self.require_known_form()
        vocab = spec["model"]["vocab"]
        self.byte_ids = np.array([vocab[c] for c in printable_bytes()], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.made = made
        self.slots, self.slot_ranks = self.hashed(keys)
        special = [t["content"] for t in spec.get("added_tokens", [])]
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern = regex.compile(PRE_TOKENS)
        self.inside_white = regex.compile(rf"[{WHITE}] (?:[{WHITE}]|\Z)")
        self.words_known: dict[str, int] = {}
        self.pieces_known: dict[str, int] = {}

    def require_known_form(self) -> None:
        """Refuses files whose tokens would need steps that are not taken here."""
        model, split = self.spec["model"], self.spec.get("pre_tokenizer") or {}
        known = (
            model.get("type") == "BPE"
            and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
            and self.spec.get("normalizer") is None
            and split.get("type") == "ByteLevel"
            and split.get("use_regex", True)
            and not split.get("add_prefix_space")
            and not any(t.get(k) for t in self.spec.get("added_tokens", []) for k in ("single_word", "lstrip", "rstrip", "normalized"))
        )
        if not known:
            raise ValueError("not a plain byte-level BPE vocabulary")

    @staticmethod
    def hashed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """An open-addressing table of the pairs, at most a quarter full: keys (-1: free) and ranks."""
        size = 1 << int(4 * len(keys)).bit_length()
        slots, ranks = np.full(size, -1, np.int64), np.full(size, NEVER, np.int32)
        left = np.arange(len(keys))
        at = spread(keys, size)
        while len(left):
            free = slots[at] == -1
            first = np.unique(at[free], return_index=True)[1]
            placed = np.flatnonzero(free)[first]
            slots[at[placed]], ranks[at[placed]] = keys[left[placed]], left[placed]
            rest = np.ones(len(left), bool)
            rest[placed] = False
            left, at = left[rest], (at[rest] + 1) % size
        return slots, ranks

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, NEVER if no merge has the pair."""
        key = left << 32 | right
        at = spread(key, len(self.slots))
        found = self.slots[at]
        rank = np.where(found == key, self.slot_ranks[at], NEVER)
        open_ = np.flatnonzero((found != key) & (found != -1))
        while len(open_):
            at[open_] = (at[open_] + 1) % len(self.slots)
            found = self.slots[at[open_]]
            rank[open_] = np.where(found == key[open_], self.slot_ranks[at[open_]], NEVER)
            open_ = open_[(found != key[open_]) & (found != -1)]
        return rank

    def merged_lengths(self, tokens: Sequence[bytes]) -> np.ndarray:
        """Symbols left of each (non-empty) pre-token when no pair can be merged any more.

        All sequences lie in one array. In every step each sequence merges all places of its
        lowest-ranked pair, overlapping ones from the left; sequences without a pair leave.
        """
        lengths = np.array([len(t) for t in tokens], np.int64)
        ids = self.byte_ids[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), lengths)
        # Rank of the pair that begins at each symbol; the last of a sequence begins none.
        rank = np.full(len(ids), NEVER, np.int32)
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self.rank_of(ids[inner], ids[inner + 1])
        while len(ids):
            begins = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            sizes = np.diff(np.append(begins, len(ids)))
            lowest = np.repeat(np.minimum.reduceat(rank, begins), sizes)
            live = lowest != NEVER
            if not live.all():
                ids, owner, rank, lowest = ids[live], owner[live], rank[live], lowest[live]
                if not len(ids):
                    break
            place = np.flatnonzero(rank == lowest)
            # In a run of neighbouring places (a pair of one symbol with itself) every second one.
            run = np.flatnonzero(np.concatenate(([True], np.diff(place) != 1)))
            offset = np.arange(len(place)) - np.repeat(run, np.diff(np.append(run, len(place))))
            place = place[offset % 2 == 0]
            ids[place] = self.made[rank[place]]
            stays = np.ones(len(ids), bool)
            stays[place + 1] = False
            lengths -= np.bincount(owner[place], minlength=len(lengths))
            # The merged symbol's pairs to both sides have new ranks.
            rank[place] = rank[place + 1]
            moved = np.cumsum(stays)[place] - 1
            ids, owner, rank = ids[stays], owner[stays], rank[stays]
            for at in (moved, moved[moved > 0] - 1):
                at = at[at + 1 < len(ids)]
                same = owner[at] == owner[at + 1]
                rank[at] = np.where(same, self.rank_of(ids[at], ids[at + 1]), NEVER)
        return lengths

    def learn(self, words: Iterable[str]) -> None:
        """Puts the counts of words into ``words_known`` by way of their pre-tokens.

        Taken in parts of about CHUNK characters. A store that has grown over KNOWN is emptied.
        """
        names: list[str] = []
        pieces: list[list[str]] = []
        size = 0
        for word in words:
            names.append(word)
            pieces.append(self.pattern.findall(word))
            size += len(word)
            if size >= CHUNK:
                self.keep(names, pieces)
                names, pieces, size = [], [], 0
        self.keep(names, pieces)

    def keep(self, names: list[str], pieces: list[list[str]]) -> None:
        wanted = set().union(*pieces)
        if len(self.pieces_known) > KNOWN:
            self.pieces_known.clear()
        new = list(wanted.difference(self.pieces_known))
        if new:
            self.pieces_known.update(zip(new, self.merged_lengths([p.encode() for p in new]).tolist()))
        of = self.pieces_known.__getitem__
        self.words_known.update((n, sum(map(of, found))) for n, found in zip(names, pieces))

    def words(self, text: str) -> list[str]:
        """Parts that can be counted apart: cut before each space.

        A pre-token has a space only as its first character or inside a run of white space. A cut
        is safe unless the space has white space before it and behind it, or the text's end there; a
        text with such a place stays whole.
        """
        if self.inside_white.search(text):
            return [text]
        first, *rest = text.split(" ")
        return [first, *map(" ".__add__, rest)]

    def counts(self, texts: Sequence[str]) -> list[int]:
        """Tokens of each text; a special string inside a text is one token."""
        cut, extra = [], []
        for text in texts:
            parts = self.special.split(text) if self.special else [text]
            extra.append(len(parts) - 1)
            cut.append([w for part in parts for w in self.words(part)])
        wanted = set().union(*cut)
        if len(self.words_known) > KNOWN:
            self.words_known.clear()
        self.learn(wanted.difference(self.words_known))
        of = self.words_known.__getitem__
        return [n + sum(map(of, found)) for n, found in zip(extra, cut)]
