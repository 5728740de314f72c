"""Heuristic labellers of text quality, and the hashed features of a linear scorer, as arrays."""

from __future__ import annotations

import numpy as np

from fraudlake.llm.word_grams import Words

UPPER, LOWER_CASE, DIGIT, SPACE, STOP, BANG, SYMBOL, BEYOND = range(8)
CLASSES = np.full(256, SYMBOL, np.uint8)
CLASSES[128:] = BEYOND
for _class, _bytes in (
    (UPPER, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    (LOWER_CASE, b"abcdefghijklmnopqrstuvwxyz"),
    (DIGIT, b"0123456789"),
    (SPACE, b" \t\n\r\x0b\x0c"),
    (STOP, b".,;:?'\"-()"),
    (BANG, b"!"),
):
    CLASSES[list(_bytes)] = _class

BAD, ABSTAIN, GOOD, SILENT = range(4)
#: Each labeller: its verdict, the fewest words it judges, and the ranges in which the signals must
#: lie. Outside of them it abstains; on shorter texts it is silent.
LABELLERS = {
    "shouting": (BAD, 3, {"upper": (0.5, 1)}),
    "symbols": (BAD, 3, {"symbol": (0.06, 1)}),
    "exclaiming": (BAD, 5, {"bang": (0.2, np.inf)}),
    "stutter": (BAD, 5, {"repeat": (0.15, 1)}),
    "few_words": (BAD, 50, {"sameness": (0.75, 1)}),
    "punctuated": (BAD, 20, {"stop": (0.7, np.inf)}),
    "prose": (GOOD, 5, {"upper": (0, 0.15), "symbol": (0, 0.03), "bang": (0, 0.05), "repeat": (0, 0.08)}),
    "sentences": (GOOD, 10, {"upper": (0.001, 0.2), "symbol": (0, 0.05), "stop": (0.03, 0.4), "repeat": (0, 0.1)}),
    "varied": (GOOD, 50, {"sameness": (0, 0.5), "symbol": (0, 0.05), "upper": (0, 0.2), "repeat": (0, 0.05)}),
}
SHAPE_BITS, WORD_BITS = 12, 13
FEATURES = (1 << SHAPE_BITS) + (1 << WORD_BITS) + 1  # the last: a word like the one before it


def per_text(owner: np.ndarray, texts: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(owner, weights, minlength=texts)


def repeats(words: Words) -> np.ndarray:
    """Whether each word is the same as the one before it in its text."""
    same = np.zeros(len(words.hashes), bool)
    same[1:] = (words.hashes[1:] == words.hashes[:-1]) & (words.owner[1:] == words.owner[:-1])
    return same


def signals(data: np.ndarray, offsets: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    """Shares per text, 0 where there is nothing to divide by."""
    texts = len(offsets) - 1
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    counts = np.bincount(owner * 8 + CLASSES[data], minlength=8 * texts).reshape(texts, 8)
    n = np.maximum(1, words.counts)
    visible = np.maximum(1, counts.sum(axis=1) - counts[:, SPACE])
    mixed = words.hashes ^ (words.owner.astype(np.uint64) << np.uint64(40))
    order = np.argsort(mixed, kind="stable")
    again = np.zeros(len(mixed), bool)
    again[order[1:]] = mixed[order[1:]] == mixed[order[:-1]]
    stop = (counts[:, STOP] + counts[:, BANG]) / n
    return {
        "words": words.counts,
        "upper": counts[:, UPPER] / np.maximum(1, counts[:, UPPER] + counts[:, LOWER_CASE]),
        "symbol": counts[:, SYMBOL] / visible,
        "repeat": per_text(words.owner, texts, repeats(words)) / n,
        "sameness": per_text(words.owner, texts, again) / n / np.maximum(1, np.log10(n) - 1),
        "bang": counts[:, BANG] / n,
        "stop": stop,
        "unstopped": 1 - np.minimum(1, stop),
        "digit": counts[:, DIGIT] / visible,
    }


def votes(found: dict[str, np.ndarray]) -> np.ndarray:
    """The votes on a text as one number: a digit to base 4 per labeller."""
    out = np.zeros(len(found["words"]), np.int64)
    for verdict, fewest, ranges in LABELLERS.values():
        fits = np.ones(len(out), bool)
        for signal, (low, high) in ranges.items():
            fits &= (found[signal] >= low) & (found[signal] <= high)
        out = out * 4 + np.where(found["words"] < fewest, SILENT, np.where(fits, verdict, ABSTAIN))
    return out


def vote_digits(pattern: np.ndarray) -> np.ndarray:
    """``(patterns, labellers)`` votes of such numbers."""
    powers = 4 ** np.arange(len(LABELLERS) - 1, -1, -1)
    return np.asarray(pattern)[:, None] // powers % 4


def features(data: np.ndarray, offsets: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, feature, value)`` of all non-zero features, by text.

    Runs of four character classes and hashed words, each as its share in the text times the square
    root of how many there are, up to 256: so long texts weigh no more than texts of some length.
    """
    texts = len(offsets) - 1
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    kinds = CLASSES[data].astype(np.int64)
    n = max(0, len(kinds) - 3)
    shape = np.zeros(n, np.int64)
    for j in range(4):
        shape = shape * 8 + kinds[j : j + n]
    whole = owner[:n] == owner[3:] if n else np.zeros(0, bool)
    word = (words.hashes >> np.uint64(64 - WORD_BITS)).astype(np.int64) + (1 << SHAPE_BITS)
    same = repeats(words)
    parts = [
        (owner[:n][whole], shape[whole]),
        (words.owner, word),
        (words.owner[same], np.full(int(same.sum()), FEATURES - 1)),
    ]
    out = []
    for (of, feature), total in zip(parts, (np.diff(offsets), words.counts, words.counts)):
        key, count = np.unique(of * FEATURES + feature, return_counts=True)
        of, feature = key // FEATURES, key % FEATURES
        size = np.maximum(1, total[of])
        # A stutter is one feature against thousands, so it counts double.
        scale = np.where(feature == FEATURES - 1, 2, 1) * np.sqrt(np.minimum(256, size)) / 16
        out.append((of, feature, count / size * scale))
    of, feature, value = (np.concatenate(x) for x in zip(*out))
    order = np.argsort(of, kind="stable")
    return of[order], feature[order], value[order]


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 500) -> tuple[np.ndarray, np.ndarray, float]:
    """Expectation-maximisation over vote patterns: ``(posterior of good, accuracies, share of good)``.

    The model: a hidden class, and labellers that depend on it alone. Each has, for either class, its
    own chance to cast its vote where it is not silent, so a good-text labeller that abstains speaks
    against a text; silence says nothing. The start: a labeller is four times as likely to vote on
    its own class. Chances are smoothed by one row of each kind. The accuracy of a labeller is the
    share of its votes that agree with the hidden class.
    """
    digits = vote_digits(patterns)
    verdicts = np.array([verdict for verdict, _, _ in LABELLERS.values()])
    heard = (digits != SILENT).astype(float)
    cast = (digits == verdicts).astype(float)
    chance = np.where(np.array([[BAD], [GOOD]]) == verdicts, 0.8, 0.2)  # class x labeller
    share = 0.5
    good = np.full(len(patterns), 0.5)
    for _ in range(rounds):
        logs = cast @ np.log(chance).T + (heard - cast) @ np.log(1 - chance).T + np.log([1 - share, share])
        new = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))
        weights = np.stack([(1 - new) * counts, new * counts])
        chance = (weights @ cast + 1) / (weights @ heard + 2)
        share = (weights[1].sum() + 1) / (counts.sum() + 2)
        moved = np.abs(new - good).max(initial=0)
        good = new
        if moved < 1e-9:
            break
    votes_cast = np.stack([(1 - good) * counts, good * counts]) @ cast
    agree = np.where(verdicts == GOOD, votes_cast[1], votes_cast[0])
    return good, (agree + 1) / (votes_cast.sum(axis=0) + 2), float(share)


class Scorer:
    """Logistic regression on hashed features."""

    def __init__(self) -> None:
        self.weights = np.zeros(FEATURES)
        self.bias = 0.0

    def fit(self, of: np.ndarray, feature: np.ndarray, value: np.ndarray, target: np.ndarray, rounds: int = 250) -> None:
        """Full-batch steps, scaled per feature by the gradients so far; both classes weigh the same."""
        n = len(target)
        good = np.clip(target.mean(), 1e-3, 1 - 1e-3) if n else 0.5
        weight = (target / good + (1 - target) / (1 - good)) / 2 / max(1, n)
        past, past_bias = np.full(FEATURES, 1e-12), 1e-12
        for _ in range(rounds):
            score = np.bincount(of, value * self.weights[feature], minlength=n) + self.bias
            error = weight * (1 / (1 + np.exp(-np.clip(score, -60, 60))) - target)
            slope = np.bincount(feature, value * error[of], minlength=FEATURES) + 1e-7 * self.weights
            past += slope**2
            past_bias += error.sum() ** 2
            self.weights -= 0.5 * slope / np.sqrt(past)
            self.bias -= 0.5 * error.sum() / np.sqrt(past_bias)

    def scores(self, data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
        of, feature, value = features(data, offsets, words)
        score = np.bincount(of, value * self.weights[feature], minlength=len(offsets) - 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(score, -60, 60)))
