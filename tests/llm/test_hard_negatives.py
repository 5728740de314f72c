import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlake.llm import hard_negatives
from fraudlake.llm.hard_negatives import OP13_SQL, mined, op13_negatives, whole_vectors
from fraudlake.llm.residues import EXACT, Residues, primes_for, products


@pytest.mark.parametrize("columns, size", [(1, 1 << 27), (64, 255), (100, 1 << 20), (64, 1 << 24), (700, 1 << 22), (0, 5)])
def test_products_are_exact_with_their_sign(columns, size):
    rng = np.random.default_rng(columns)
    a, b = (rng.integers(-size, size, (n, columns)) for n in (7, 9))
    a[0], b[0], b[1] = size, size, -size
    want = a.astype(object) @ b.astype(object).T if columns else np.zeros((7, 9), object)
    bound = max(1, columns) * size * size
    primes = primes_for(columns, bound)
    assert len(set(primes)) == len(primes) and np.prod(np.array(primes, object)) > 2 * bound + 1
    assert all((p // 2) ** 2 * min(columns, 64) < EXACT for p in primes)
    got = products(Residues(a, primes), Residues(b, primes))
    assert got.dtype == np.int64 and (got == want).all()


def brute(rows, every, positives=5, negatives=10):
    out = []
    usable = [(i, y, [int(np.floor(256 * np.float64(x))) for x in v]) for i, y, v in rows]
    usable = [r for n, r in enumerate(usable) if r not in usable[:n]]
    for a, label, v in usable:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, y) for i, y, w in usable if i != a and len(w) == len(v))
        for s, p, _ in [r for r in scored if r[2] == label][:positives]:
            hard = [(n, -t) for t, n, y in scored if y != label and -30 * s <= -100 * t <= -90 * s][:negatives]
            out += [(a, p, k + 1, n, -s, t) for k, (n, t) in enumerate(hard)]
    return sorted(out)


def data(n, seed=0, dims=6):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) * 0.4 + 0.3
    x[::4] = x[1]  # many ties
    return [(i, int(rng.integers(0, 4)), x[i].astype(np.float32).tolist()) for i in range(n)]


def results(df):
    return sorted(map(tuple, df.collect()))


def test_against_brute_force_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 60)
    rows = data(400)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int".replace("embedding array<float>, label int", "label int, embedding array<float>"))
    got = results(mined(whole_vectors(df, "vec_id", "embedding", "label"), 10, anchor_rows=15))
    assert got == brute(rows, 10) and len(got) > 500


def test_query_and_sql_agree(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    want = con.sql(OP13_SQL)
    got = op13_negatives(spark, sf_dir)
    assert got.columns == want.columns
    assert results(got) == sorted(want.fetchall()) and got.count() > 0


def test_hard_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = data(120, 5, 3)
    good = rows + [(200, 1, [0.5, 0.5]), (300, 1, [0.6, 0.4]), (301, 2, [0.2, 0.3]), (400, 2, []), (401, 2, []), (402, 3, []), (-100, 1, [1.0, 1.0, 1.0])]
    bad = [(500, None, [1.0] * 3), (600, 1, None), (700, 1, [1.0, None, 1.0]), (800, 1, [nan, 1.0, 1.0]), (900, 1, [inf, 1.0, 1.0]), (None, 1, [1.0] * 3)]
    df = spark.createDataFrame(good + bad + good[:7], "vec_id long, label int, embedding array<double>")
    df = df.withColumns({"id": F.lit("x"), "row": F.lit(1), "block": F.lit(None)})
    run = lambda d: mined(whole_vectors(d, "vec_id", "embedding", "label"), 20)
    assert results(run(df)) == brute(good, 20)
    assert run(df.limit(0)).count() == 0
    huge = df.withColumn("embedding", F.transform("embedding", lambda x: x * 1e200))
    with pytest.raises(ValueError):
        run(huge)
    large = spark.createDataFrame([(i, y, [x * 1e4 for x in v]) for i, y, v in data(50, 3)], "vec_id long, label int, embedding array<double>")
    assert results(run(large)) == brute([(r[0], r[1], r[2]) for r in large.collect()], 20)
