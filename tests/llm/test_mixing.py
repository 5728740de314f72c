import random
import re
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
from pyspark.sql import functions as F

from fraudlake.llm.mixing import OP4_SQL, golden_point, mix, op4_mixing


def plain_targets(sizes, weights=(5, 2, 1), most=3):
    """Proportional shares, again and again without those that stop."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    left, open_, out = Fraction(sum(sizes.values())), set(names), {}
    while True:
        total = sum(w[n] for n in open_)
        over = {n for n in open_ if left * w[n] / total > most * sizes[n]} if total else set()
        if not over:
            return out | {n: left * w[n] / total for n in open_}
        for n in over:
            out[n] = Fraction(most * sizes[n])
            left -= out[n]
        open_ -= over


def test_mix_of_uneven_sources(spark):
    rng = random.Random(2)
    rows = []
    for i in range(300):
        source = rng.choice(["a", "a", "a", "a", "b", "c", None, "É"]) if i else "tiny"
        rows.append((i, " ".join("w" * rng.randint(1, 60)), source))
    rows += [(None, None, "a"), (None, None, "a"), (5, "x y", "b"), (5, "x y", "b"), (600, " \t\n", "blank"), (601, "q " * 5000, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"size": F.lit("x"), "block": F.lit(1)})
    slots, taken = mix(docs, ["doc_id"], block=16)
    got = taken.collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    want = plain_targets(sizes)
    by = defaultdict(int)
    for r in got:
        name = None if r.source_key == "t" else r.source_key[1:]
        assert r.source_size == sizes[name] and abs(r.target - float(want[name])) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        by[name] += r.taken
    assert all(abs(by[n] - want[n]) <= 0.5 for n in want)
    # the schedule takes the same words, and every stretch of it is near the weights
    order = slots.orderBy("slot").collect()
    per = defaultdict(int)
    for s in order:
        per[s.source_key] += s.take
    assert all(per["t" if n is None else "s" + n] == by[n] for n in by)
    half = Counter(s.source_key for s in order[: len(order) // 2])
    whole = Counter(s.source_key for s in order)
    assert all(abs(half[k] - whole[k] / 2) < 6 for k in whole)


def test_points_are_those_of_the_golden_ratio(spark):
    rows = spark.range(2000).select("id", golden_point("id").alias("p")).collect()
    ratio = (5**0.5 - 1) / 2
    assert all(abs(r.p - r.id * ratio % 1) < 1e-9 for r in rows)


def test_query_against_sql(spark, sf_dir):
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    key = lambda r: r[0]
    assert sorted(map(tuple, op4_mixing(spark, sf_dir).collect()), key=key) == sorted(duckdb.sql(OP4_SQL).fetchall(), key=key)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    slots, taken = mix(docs, ["doc_id"])
    assert slots.count() == 0 and taken.count() == 0
