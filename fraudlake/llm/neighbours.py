"""Approximate nearest neighbours by inner product: a robust-pruned graph per shard, beam-searched.

Equal vectors are one point. Points are dealt to shards of bounded size by the power of two of their
length and by a hash, so that vectors of very different lengths share no graph; a task builds the
graph of its shard: each new point is searched for greedily, and of what the search met it keeps
diverse neighbours, so that edges lead into every direction. Queries go to every shard in blocks of
bounded size, each block with its copy of the shard's graph; the best of all shards are merged.
Scores are inner products of the original vectors in double precision.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fraudlake.llm.common import stash, table
from fraudlake.llm.pruned_graph import BATCH, NONE, PrunedGraph, directions, lifted

SHARD_ROWS = 8192
QUERY_BLOCK = 8192
BEAM = 96
MOST_TASKS = 1 << 14  # of a search; beyond it a task has several shards or blocks, one after the other
NEAREST = 20

INDEX_SQL = "part int, node int, entry boolean, ids array<long>, vector array<float>, edges array<int>"
FOUND_SQL = "query_id long, vec_id long, score double"


def matrix(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    whole = column.combine_chunks()
    return whole.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(whole), -1)


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(id, vector)`` of the rows that take part."""
    finite = F.forall(F.col("vector"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.select(F.col(vec_id).alias("id"), F.col(vector).cast("array<float>").alias("vector")).where(
        F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0)
    )


def norm_band() -> Column:
    """The power of two nearest to the length of ``vector``, which is not 0.

    The length is taken in double precision, where no single-precision vector overflows or vanishes.
    Unit vectors, whose lengths differ by rounding, are in one band.
    """
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return F.floor(F.log2(square) / 2 + 0.5).cast("int")


def build_index(rows: DataFrame, nearest: int = NEAREST, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The graphs of all ``(id, vector)`` rows: a row per distinct vector, see INDEX_SQL.

    Of the ids of equal vectors the ``nearest + 1`` smallest are kept: by the order of the result no
    other can be among the nearest of any query. The limit is applied before the shuffle too, so a
    vector that a third of the rows have costs as many rows as any other.
    """
    first = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    classes = stash(
        rows.distinct()
        .withColumn("place", first)
        .where(F.col("place") <= nearest + 1)
        .groupBy("vector")
        .agg(F.array_sort(F.collect_list("id")).alias("ids"))
        .withColumn("band", norm_band())
    )
    kinds = {"length": F.size("vector"), "band": F.col("band")}
    shards = classes.groupBy(*(c.alias(n) for n, c in kinds.items())).count().orderBy(*kinds).collect()
    number, base = F.lit(None).cast("int"), 0
    for r in shards:  # one entry per vector length and norm band
        parts = -(-r["count"] // shard_rows)
        place = (F.pmod(F.xxhash64("vector"), F.lit(parts)) + base).cast("int")
        number = F.when((kinds["length"] == r["length"]) & (kinds["band"] == r["band"]), place).otherwise(number)
        base += parts

    def build(shard: pa.Table) -> pa.Table:
        shard = shard.sort_by("order")
        vectors = matrix(shard["vector"], np.float32)
        graph = PrunedGraph(lifted(vectors))
        n = len(vectors)
        return pa.table(
            {
                "part": shard["part"],
                "node": pa.array(np.arange(n, dtype=np.int32)),
                "entry": pa.array(np.arange(n) == graph.entry),
                "ids": shard["ids"],
                "vector": shard["vector"],
                "edges": pa.array(list(graph.edges), pa.list_(pa.int32())),
            }
        )

    # A task for each shard: by their bytes alone, Spark would build several graphs in one task.
    placed = (
        classes.withColumn("part", number)
        .withColumn("order", F.element_at("ids", 1))
        .repartitionById(max(1, base), F.col("part"))
    )
    return stash(placed.groupBy("part").applyInArrow(build, INDEX_SQL))


def search_index(
    index: DataFrame, queries: DataFrame, nearest: int = NEAREST, beam: int = BEAM, block: int = QUERY_BLOCK
) -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the ``(id, vector)`` rows of ``queries``.

    The beam is ``beam`` wide, or as wide as vectors are long: in more dimensions the nearest are
    less far ahead of the others. A query's own id is left out. Ties go to the smaller ``vec_id``. Queries meet only vectors of
    their length.
    """
    parts = index.groupBy("part").agg(F.size(F.first("vector")).alias("length"))
    blocks = max(1, -(-queries.count() // block))
    asked = queries.distinct().withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.lit(blocks)).cast("int"))
    sent = asked.withColumn("length", F.size("vector")).join(parts, "length").drop("length")
    copies = index.withColumn("of_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    copies = copies.withColumn("of_part", F.col("part") + 0).drop("part")

    def search(shard: pa.Table, asked: pa.Table) -> pa.Table:
        out_query, out_id, out_score = [], [], []
        if len(shard) and len(asked):
            shard = shard.sort_by("node")
            vectors = matrix(shard["vector"], np.float32)
            entry = int(np.flatnonzero(shard["entry"].to_numpy())[0])
            graph = PrunedGraph(lifted(vectors), matrix(shard["edges"], np.int32), entry)
            ids = shard["ids"].combine_chunks()
            starts, flat = ids.offsets.to_numpy(), ids.values.to_numpy()
            wanted, own = matrix(asked["vector"], np.float32), asked["id"].to_numpy()
            for a in range(0, len(own), BATCH):
                some = wanted[a : a + BATCH]
                found = graph.search(directions(some), max(beam, some.shape[1], nearest + 1))[0]
                for query, vector, nodes in zip(own[a : a + BATCH], some.astype(np.float64), found):
                    nodes = nodes[nodes != NONE]
                    scores = vectors[nodes].astype(np.float64) @ vector
                    counts = starts[nodes + 1] - starts[nodes]
                    which = np.concatenate([flat[starts[n] : starts[n + 1]] for n in nodes])
                    score = np.repeat(scores, counts)
                    score, which = score[which != query], which[which != query]
                    best = np.lexsort((which, -score))[:nearest]
                    out_query.append(np.full(len(best), query))
                    out_id.append(which[best])
                    out_score.append(score[best])
        join = lambda arrays, kind: np.concatenate(arrays) if arrays else np.zeros(0, kind)
        return pa.table(
            {
                "query_id": pa.array(join(out_query, np.int64), pa.int64()),
                "vec_id": pa.array(join(out_id, np.int64), pa.int64()),
                "score": pa.array(join(out_score, np.float64), pa.float64()),
            }
        )

    tasks = min(MOST_TASKS, max(1, parts.count() * blocks))
    sent = sent.repartition(tasks, "part", "block")
    copies = copies.repartition(tasks, "of_part", "of_block")
    found = sent.groupBy("part", "block").cogroup(copies.groupBy("of_part", "of_block")).applyInArrow(
        lambda asked, shard: search(shard, asked), FOUND_SQL
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= nearest)


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated ids: the nearest of all vectors with that id are ranked together."""
    rows = usable(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    queries = rows.where(F.pmod("id", F.lit(20)) == 0)
    return search_index(build_index(rows), queries).select("query_id", "rank", "vec_id", "score")
