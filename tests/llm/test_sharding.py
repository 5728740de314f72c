import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fraudlake.llm import common, sharding
from fraudlake.llm.common import table
from fraudlake.llm.sharding import op2_shards, shard_documents


def plain(texts, shards):
    """digest -> shard, by trying every capacity that a run of groups can have."""
    sizes = defaultdict(int)
    for t in texts:
        raw = (t or "").encode()
        sizes[hashlib.md5(raw).hexdigest()] += len(raw) + 1
    out, left = {}, sum(sizes.values())
    for digest in sorted(sizes, key=lambda d: (-sizes[d], d)):
        if len(out) == shards - 1 or sizes[digest] * (shards - len(out)) < left:
            break
        left -= sizes[digest]
        out[digest] = len(out)
    own = len(out)
    rest = sorted(d for d in sizes if d not in out)

    def fill(capacity):
        placed, shard, used = {}, own, 0
        for d in rest:
            if used + sizes[d] > capacity:
                shard, used = shard + 1, 0
            if sizes[d] > capacity or shard >= shards:
                return None
            placed[d] = shard
            used += sizes[d]
        return placed

    low, high = 0, left
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fill(middle) is not None else (middle + 1, high)
    return out | fill(low)


def check(spark, rows, shards=8):
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"size": F.lit("x"), "shard": F.lit(9), "order": F.lit(1)})
    got = shard_documents(docs, ["doc_id"], shards=shards).collect()
    want = plain([t for _, t in rows], shards)
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        assert r.shard == want[r.digest]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return slots


@pytest.mark.parametrize("seed, digits", [(1, 3), (2, 1), (3, 1)])
def test_against_plain_search(spark, monkeypatch, seed, digits):
    monkeypatch.setattr(sharding, "FIRST_DIGITS", digits)
    monkeypatch.setattr(sharding, "MORE_DIGITS", 1)
    rng = random.Random(seed)
    rows = [(i, "x" * rng.choice([1, 5, 50, 500]) + str(rng.randint(0, 150))) for i in range(500)]
    assert len(check(spark, rows)) == 8


def test_hot_group_few_groups_nulls_and_no_rows(spark):
    rng = random.Random(4)
    rows = [(None, "copy of a long text " * 9)] * 150 + [(i, "t" * rng.randint(0, 90)) for i in range(200)] + [(7, None), (7, ""), (7, None)]
    assert len(check(spark, rows)) == 8
    assert len(check(spark, [(1, "a"), (1, "a"), (2, "b"), (3, "c")])) == 3
    assert len(check(spark, [(1, "a"), (2, "b")], shards=1)) == 1
    assert check(spark, []) == {}


def test_query(spark, sf_dir):
    texts = {r.doc_id: r.text for r in table(spark, sf_dir, "documents").collect()}
    got = op2_shards(spark, sf_dir).collect()
    want = plain(texts.values(), 8)
    assert {r.doc_id for r in got} == set(texts) and len(got) == len(texts)
    for r in got:
        raw = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        assert r.shard == want[hashlib.md5(raw).hexdigest()]


def test_equal_rows_are_in_pieces_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(common, "ROWS_PER_BUCKET", 16)
    rows = [(7, "copy")] * 500 + [(i, f"text {i % 90}") for i in range(400)]
    keyed = spark.createDataFrame(rows, "doc_id long, text string").withColumn("order", common.row_key("doc_id", "text"))
    pieces = common.with_pieces(keyed, "order", "piece")
    sizes = {r["piece"]: r["count"] for r in pieces.groupBy("piece").count().collect()}
    assert sum(sizes.values()) == 900 and max(sizes.values()) < 64
    places = [(r.piece, r.order) for r in pieces.select("piece", "order").collect()]
    digits = common.hex_digits_for(900, 16)
    assert all(order.startswith(piece[:digits]) for piece, order in places)
    assert len(check(spark, rows)) == 8
