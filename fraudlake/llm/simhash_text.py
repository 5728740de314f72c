"""SimHash of one text: majority bits of the XXH64 values of its word shingles."""

from __future__ import annotations

import numpy as np
import xxhash

SEED = 42
BLOCK = 1 << 15  # shingles hashed and summed at once, so that memory does not follow the text


def fingerprint(text: bytes | None, width: int = 3) -> int:
    """64-bit fingerprint, unsigned. No words: 0; fewer words than ``width``: one shingle of all.

    Words are runs of bytes other than ASCII white space, after lower-casing A-Z; shingles keep
    their repeats. A bit is 1 if it is set in over half of the hashes.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    n = len(words) - width + 1
    breaks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = np.concatenate(([0], breaks[: n - 1] + 1)).tolist()
    ends = np.concatenate((breaks[width - 1 :], [len(joined)])).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for low in range(0, n, BLOCK):
        hashes = np.array(
            [digest(joined[a:b], SEED) for a, b in zip(starts[low : low + BLOCK], ends[low : low + BLOCK])],
            dtype="<u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << int(i) for i in np.flatnonzero(2 * ones > n)))
