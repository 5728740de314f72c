"""Hard negatives: rows of another label whose score lies in a window below that of a positive.

Scores are exact integer inner products by a residue number system (see ``residues``). Anchors and rows
are dealt to blocks of bounded size, and every block of anchors meets every block of rows in a task of
its own: a stated query set against all rows. A first pass keeps each anchor's best rows of its own
label, which set the windows; a second one keeps the best rows of other labels inside each window. A
task returns a few rows for each anchor, the best of which are ranked by Spark.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fraudlake.llm.common import stash, table
from fraudlake.llm.neighbours import matrix
from fraudlake.llm.residues import Residues, primes_for, products

BLOCK_ROWS = 4096
ANCHOR_ROWS = 1024
POSITIVES = 5
NEGATIVES = 10
LOWEST, HIGHEST = 30, 90  # per cent of the positive's score
SCALE = 256
LARGEST = 1 << 56  # of a score, so that a hundred times it fits into 64 bits
PAIR_SQL = "row long, anchor_id long, place int, positive_id long, positive_score long, id long, score long"


def whole_vectors(rows: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """``(id, label, vector, norm)`` of the rows that take part, components as whole numbers."""
    finite = F.forall(F.col("raw"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.select(
        F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).cast("array<double>").alias("raw")
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("raw").isNotNull() & finite)
    scaled = F.transform("raw", lambda x: F.floor(x * SCALE))
    square = F.aggregate("raw", F.lit(0.0), lambda t, x: t + F.pow(F.abs(x * SCALE) + 1, F.lit(2.0)))
    return usable.select("id", "label", scaled.alias("vector"), square.alias("norm"))


def numbered(rows: DataFrame) -> DataFrame:
    """Distinct rows with a number and a block, written: at most about BLOCK_ROWS rows a block."""
    kept = stash(rows.distinct().withColumn("row", F.monotonically_increasing_id()).withColumn("size", F.size("vector")))
    blocks = max(1, -(-kept.count() // BLOCK_ROWS))
    return kept.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn("blocks", F.lit(blocks))


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` largest scores in falling order, ties by id."""
    if len(scores) > k:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some]))[:k]]


def block_pairs(anchors: DataFrame, rows: DataFrame, anchor_rows: int, choose: Callable, primes: dict[int, list[int]]) -> DataFrame:
    """What ``choose(anchor, scores, labels, ids)`` takes of every block of rows for every anchor.

    ``anchors`` has the columns of ``rows`` and ``positives``. Vectors meet those of their length.
    """
    ways = max(1, -(-anchors.count() // anchor_rows))
    way = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(ways)).cast("int")
    asked = anchors.withColumn("way", way).withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    copies = rows.withColumn("of_way", F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
    # No column under the name it has on the other side: a cogroup of one frame with itself mixes them up.
    here = {"id": "of_id", "label": "of_label", "vector": "toward", "size": "of_size", "block": "of_block"}
    copies = copies.select(*((F.col(c) + 0 if c != "vector" else F.col(c)).alias(n) for c, n in here.items()), "of_way")

    def run(asked: pa.Table, block: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(asked) and len(block):
            use = primes[asked["size"][0].as_py()]
            scores = products(Residues(matrix(asked["vector"], np.int64), use), Residues(matrix(block["toward"], np.int64), use))
            ids, labels = block["of_id"].to_numpy(), block["of_label"].to_numpy()
            keys = zip(*(asked[c].to_pylist() for c in ("row", "id", "label", "positives")))
            for (row, anchor, label, positives), own in zip(keys, scores):
                for place, positive, at, some in choose(anchor, label, positives, own, labels, ids):
                    out += [(row, anchor, place, positive, at, i, s) for i, s in zip(ids[some].tolist(), own[some].tolist())]
        columns = list(zip(*out)) or [()] * 7
        kinds = [pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 4]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=[f.split()[0] for f in PAIR_SQL.split(", ")])

    met = asked.groupBy("size", "way", "block").cogroup(copies.groupBy("of_size", "of_way", "of_block"))
    return met.applyInArrow(run, PAIR_SQL)


def mined(
    rows: DataFrame, anchor_every: int, positives: int = POSITIVES, negatives: int = NEGATIVES, anchor_rows: int = ANCHOR_ROWS
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` among rows of
    ``(id, label, vector, norm)`` as of ``whole_vectors``; anchors are the ids divisible by ``anchor_every``.

    Rows without an id, a label or a vector, or with a null or non-finite component, take no part.
    Rows that are equal in everything count once. A row of the anchor's id is not its positive or
    negative; ids that stand for several different rows take part with each. Ties go to the smaller id.
    Vectors meet those of their length; empty ones have score 0. A positive without a row in its
    window has no result, and a window is empty below 0. Scores beyond 2^56 are refused. An empty
    table gives no rows.
    """
    rows = numbered(rows)
    sizes = rows.groupBy("size").agg(F.max("norm").alias("norm")).orderBy("size").collect()  # one entry per vector length
    if any(r["norm"] >= LARGEST for r in sizes):
        raise ValueError("scores of such vectors pass 64 bits")
    primes = {r["size"]: primes_for(r["size"], int(r["norm"]) + 1) for r in sizes}
    anchors = rows.where(F.pmod("id", F.lit(anchor_every)) == 0)

    def nearest(anchor, label, _, scores, labels, ids):
        same = np.flatnonzero((labels == label) & (ids != anchor))
        yield 0, None, None, same[best(scores[same], ids[same], positives)]

    def windowed(anchor, label, wanted, scores, labels, ids):
        other = np.flatnonzero((labels != label) & (ids != anchor))
        hundred = 100 * scores[other]
        for positive in wanted:
            at = positive["score"]
            some = other[(hundred >= LOWEST * at) & (hundred <= HIGHEST * at)]
            yield positive["place"], positive["id"], at, some[best(scores[some], ids[some], negatives)]

    order = [F.desc("score"), "id"]
    none = F.lit(None).cast("array<struct<place: int, id: long, score: long>>")
    place = F.row_number().over(Window.partitionBy("row").orderBy(*order))
    near = block_pairs(anchors.withColumn("positives", none), rows, anchor_rows, nearest, primes)
    near = near.withColumn("place", place).where(F.col("place") <= positives)
    lists = stash(near.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("positives")))
    found = block_pairs(anchors.join(lists, "row"), rows, anchor_rows, windowed, primes)
    rank = F.row_number().over(Window.partitionBy("row", "place").orderBy(*order))
    return found.withColumn("rank", rank).where(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whole_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")
    changed = F.when(F.pmod("id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mined(rows.withColumn("label", changed), 100)


OP13_SQL = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
      [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
      WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
      list_sum([a.v[i] * b.v[i] FOR i IN range(1, len(a.v) + 1)]) AS score
      FROM e AS a JOIN e AS b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, CAST(positive_score AS BIGINT) AS positive_score, CAST(score AS BIGINT) AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""
