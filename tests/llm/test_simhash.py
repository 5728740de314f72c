import random

import pytest
from pyspark.sql import functions as F
import xxhash

from fraudlake.llm.simhash import components, linked_pairs, near_duplicate_classes
from fraudlake.llm.simhash_text import fingerprint
from fraudlake.llm.common import table


def plain_fingerprint(text, width=3):
    raw = (text or "").encode()
    words, word = [], bytearray()
    for byte in raw + b" ":
        if byte == 0x20 or 9 <= byte <= 0x0D:
            if word:
                words.append(bytes(word))
            word = bytearray()
        else:
            word.append(byte + 32 if 65 <= byte <= 90 else byte)
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    parent = list(range(len(prints)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(prints)):
        for y in range(x):
            if bin(prints[x][1] ^ prints[y][1]).count("1") <= 3:
                parent[root(x)] = root(y)
    groups = {}
    for x in range(len(prints)):
        groups.setdefault(root(x), []).append(prints[x][0])
    out = []
    for x, (i, f) in enumerate(prints):
        ids = [j for j in groups[root(x)] if j is not None]
        out.append((i, f, min(ids) if ids else None))
    return out


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one two", "A b c", "a b c d " * 40, "É é\x00x y z\x1f w", "x" * 100_000])
def test_fingerprint_against_plain(text):
    assert fingerprint(None if text is None else text.encode()) == plain_fingerprint(text)


def test_blocks_do_not_change_the_fingerprint(monkeypatch):
    text = " ".join(random.Random(1).choices(["ab", "cd", "efg", "h"], k=500))
    want = plain_fingerprint(text)
    monkeypatch.setattr("fraudlake.llm.simhash_text.BLOCK", 7)
    assert fingerprint(text.encode()) == want


@pytest.mark.parametrize("distance", [0, 1, 2, 3])
def test_links_against_all_pairs(spark, distance):
    rng = random.Random(distance)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values):
        for _ in range(4):
            w = v
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                w ^= 1 << bit
            values.add(w)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    found = linked_pairs(spark.createDataFrame([(v,) for v in signed], "fp long"), distance).collect()
    pairs = [tuple(sorted(r)) for r in found]
    mask = (1 << 64) - 1
    want = {
        tuple(sorted((a, b)))
        for a in signed
        for b in signed
        if a < b and bin((a ^ b) & mask).count("1") <= distance
    }
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 160)]
    out = dict(components(spark.createDataFrame(chain + star, "a long, b long")).collect())
    assert {out[i] for i in range(41)} == {0} and {out[i] for i in range(100, 160)} == {100}


def test_classes_of_the_table_against_brute_force(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").select("doc_id", "text").collect()]
    got = near_duplicate_classes(table(spark, sf_dir, "documents")).drop("class").collect()
    mask = (1 << 64) - 1
    assert sorted((r[0], r[1] & mask, r[2]) for r in got) == sorted(plain_components(rows))


def test_hard_rows(spark):
    rows = [(5, None), (None, None), (3, ""), (7, "a b c d"), (7, "a b c d"), (None, "q r s"), (2, "a  b c D")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"fp": F.lit("x"), "component": F.lit(1), "node": F.lit(2)}
    )
    got = near_duplicate_classes(docs).drop("class").collect()
    mask = (1 << 64) - 1
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or -1)
    assert sorted(((r[0], r[1] & mask, r[2]) for r in got), key=key) == sorted(plain_components(rows), key=key)
    assert near_duplicate_classes(docs.limit(0)).count() == 0
