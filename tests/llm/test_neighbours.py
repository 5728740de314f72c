import numpy as np
from pyspark.sql import functions as F

from fraudlake.llm.common import table
from fraudlake.llm.neighbours import build_index, op8_neighbours, search_index, usable
from fraudlake.llm.pruned_graph import DEGREE, NONE, PrunedGraph, directions, lifted


def brute(rows, queries, k=20):
    out = {}
    for q, v in queries:
        scored = [(-float(np.dot(np.asarray(v, np.float64), np.asarray(w, np.float64))), i) for i, w in rows if i != q and len(w) == len(v)]
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


def test_graph_is_diverse_and_searchable():
    rng = np.random.default_rng(0)
    points = lifted(rng.normal(size=(3000, 16)) * rng.uniform(0.5, 2, (3000, 1)))
    graph = PrunedGraph(points)
    assert graph.edges.shape == (3000, DEGREE) and not (graph.edges == np.arange(3000)[:, None]).any()
    rows = [set(e[e != NONE]) for e in graph.edges]
    assert all(len(r) == (e != NONE).sum() for r, e in zip(rows, graph.edges))
    queries = points[::30]
    exact = np.argsort(((queries[:, None] - points[None]) ** 2).sum(axis=2), axis=1)[:, :10]
    got = graph.search(queries, 64)[0]
    assert np.mean([len(set(g[:10]) & set(e)) / 10 for g, e in zip(got, exact)]) > 0.95


def test_recall_and_scores_on_the_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf_dir, "embeddings").collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0])
    got = found(op8_neighbours(spark, sf_dir))
    assert got.keys() == want.keys()
    vectors = {i: np.asarray(v, np.float64) for i, v in rows}
    hits = total = 0
    for q, list_ in got.items():
        assert len(list_) == len(want[q])
        assert all(abs(s - vectors[q] @ vectors[i]) < 1e-12 for i, s in list_)
        hits += len({i for i, _ in list_} & {i for i, _ in want[q]})
        total += len(want[q])
    assert hits / total >= 0.95


def test_shards_blocks_copies_and_bad_vectors(spark):
    rng = np.random.default_rng(1)
    data = [(i, rng.normal(size=4).astype(np.float32).tolist()) for i in range(300)]
    data[40] = (40, [3.0, -4.0, 5.0, 6.0])
    data += [(1000 + i, data[40][1]) for i in range(60)] + [(2000, [1.0, 2.0]), (2001, [0.5, 0.5])]
    bad = [(5000, None), (5020, [0.0] * 4), (5040, [1.0, None, 1.0, 1.0]), (5060, [float("nan"), 1.0, 1.0, 1.0]), (5080, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (5100, [])]
    df = spark.createDataFrame(data + bad + data[:3], "vec_id long, embedding array<float>").withColumns({"id": F.lit("x"), "part": F.lit(1)})
    rows = usable(df, "vec_id", "embedding")
    queries = rows.where("id % 20 = 0")
    got = found(search_index(build_index(rows, shard_rows=50), queries, block=7))
    want = brute(data, [r for r in data if r[0] % 20 == 0])
    assert got.keys() == want.keys()
    for q in want:
        assert [i for i, _ in got[q]] == [i for i, _ in want[q]]
        assert np.allclose([s for _, s in got[q]], [s for _, s in want[q]], rtol=1e-12)
    assert [i for i, _ in got[40]][:20] == list(range(1000, 1020))


def test_few_and_no_rows(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0])], "id long, vector array<float>")
    assert found(search_index(build_index(few), few.where("id = 0"))) == {0: [(1, 2.0), (2, 0.0)]}
    none = few.limit(0)
    assert search_index(build_index(none), none).count() == 0


def test_recall_beside_one_huge_vector(spark):
    rng = np.random.default_rng(2)
    unit = rng.normal(size=(1500, 16))
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    for scale in (3e3, 1e6, 3e19, 1e38):
        data = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(unit)]
        data[7] = (7, (unit[7] * scale).astype(np.float32).tolist())
        rows = spark.createDataFrame(data, "id long, vector array<float>")
        some = [r for r in data if r[0] % 50 == 0]
        want = brute(data, some)
        got = found(search_index(build_index(rows), rows.where("id % 50 = 0")))
        assert got.keys() == want.keys()
        hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
        assert hits >= 0.95 * sum(map(len, want.values()))


def test_one_graph_over_many_lengths():
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(1000, 8)) * 1e-30).astype(np.float32)
    vectors[3] = 1e-26
    points = lifted(vectors)
    queries = directions(vectors[::20])
    exact = np.argsort(-(queries[:, :-1] @ vectors.astype(np.float64).T), axis=1)[:, :10]
    got = PrunedGraph(points).search(queries, 96)[0]
    assert np.mean([len(set(g[:10]) & set(e)) / 10 for g, e in zip(got, exact)]) > 0.95


def test_recall_in_many_dimensions_over_several_shards(spark):
    vectors = np.random.default_rng(6).normal(size=(3000, 256)).astype(np.float32)
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<float>")
    rows = usable(df, "vec_id", "embedding")
    index = build_index(rows, shard_rows=1000)
    assert index.select("part").distinct().count() >= 3
    asked = list(range(0, 3000, 60))
    got = found(search_index(index, rows.where(F.col("id") % 60 == 0)))
    scores = vectors[asked].astype(np.float64) @ vectors.T.astype(np.float64)
    scores[np.arange(len(asked)), asked] = -np.inf
    exact = np.argsort(-scores, axis=1)[:, :20]
    assert np.mean([len({i for i, _ in got[q]} & set(e)) / 20 for q, e in zip(asked, exact)]) >= 0.95
