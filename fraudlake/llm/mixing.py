"""Mixing sources to target weights by a low-discrepancy schedule of token blocks.

Method. The documents of a source, in the order of a digest, form one sequence of words that is cut
into blocks of equal length. Slots of the mix are numbered; the golden-ratio point of a slot, mapped
through the cumulative weights, names its source, and the rank of the slot among those of its source
names its block: round after round through the source until its target is met. The last slot of a
source takes only the words still missing, and slots that the sequence gives a source too few come
last, so each source takes its target to the word. The discrepancy of the sequence keeps every
stretch of the mix close to the weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fraudlake.llm.common import row_key, stash, table, with_pieces, with_running

WEIGHTS = (5, 2, 1)  # of the sources in the order of their names, repeating
MOST_REPEATS = 3
BLOCK = 1024  # words
GOLDEN = 11400714819323198485  # 2^64 divided by the golden ratio, odd
WORDS = r"[^\x20\x09-\x0D]+"
FRACTION_BITS = 52


def word_count(text: str) -> F.Column:
    """Runs of anything but ASCII white space; null: 0."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def source_key(source: str) -> F.Column:
    """A non-null key that sorts as the source by code point, null last."""
    return F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("t"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Adds ``weight`` and ``target`` to ``(source_key, source_size)``, one row per source.

    Targets are in proportion to the weights and add up to all sizes; a source stops at ``most``
    times its size and the others share the excess by weight. With the sources in the order of
    that bound per unit of weight, those up to some place stop; the level of the others is what
    is left for one unit of weight.
    """
    ranked = sizes.withColumn(
        "weight",
        F.element_at(
            F.array(*map(F.lit, weights)),
            F.pmod(F.row_number().over(Window.orderBy("source_key")) - 1, F.lit(len(weights))) + 1,
        ),
    )
    bound = (F.lit(most) * F.col("source_size")).cast("double")
    level = Window.orderBy(F.col("bound") / F.col("weight"), "source_key")
    before = level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = (
        ranked.withColumn("bound", bound)
        .withColumn("all_words", F.sum("source_size").over(everything))
        .withColumn("stopped", F.coalesce(F.sum("bound").over(before), F.lit(0.0)))
        .withColumn("open_weight", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", (F.col("all_words") - F.col("stopped")) / F.col("open_weight"))
        # The first source whose bound lies above the level, and all after it, are at that level.
        .withColumn("above", F.when(F.col("level") <= F.col("bound") / F.col("weight"), F.col("level")))
        .withColumn("level", F.first("above", ignorenulls=True).over(level.rowsBetween(Window.unboundedPreceding, 0)))
    )
    target = F.when(F.col("level").isNull(), F.col("bound")).otherwise(F.least("bound", F.col("level") * F.col("weight")))
    return levels.select("source_key", "source_size", "weight", target.alias("target"))


def plan(sources: DataFrame, block: int) -> DataFrame:
    """Adds per source: ``wanted`` words, ``blocks``, ``slots`` needed, and its stretch of [0, 1)."""
    size, want = F.col("source_size"), F.col("wanted")
    rounds = F.when(size > 0, F.floor(want / F.greatest(size, F.lit(1)))).otherwise(0).cast("long")
    before = Window.orderBy("source_key").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        sources.withColumn("wanted", F.round("target").cast("long"))
        .withColumn("blocks", F.ceil(size / F.lit(block)).cast("long"))
        .withColumn("rounds", rounds)
        .withColumn("slots", F.col("rounds") * F.col("blocks") + F.ceil((want - F.col("rounds") * size) / F.lit(block)))
        .withColumn("all_slots", F.sum("slots").over(everything))
        .withColumn("low", F.coalesce(F.sum("slots").over(before), F.lit(0)) / F.greatest("all_slots", F.lit(1)))
        .withColumn("high", (F.coalesce(F.sum("slots").over(before), F.lit(0)) + F.col("slots")) / F.greatest("all_slots", F.lit(1)))
    )


def golden_point(slot: str) -> F.Column:
    """The slot's point in [0, 1): the fraction of its number times the golden ratio, to 52 bits.

    The product is taken modulo 2^52 in two halves of the factor, so that no step overflows.
    """
    factor = GOLDEN >> (64 - FRACTION_BITS) | 1
    half = 1 << (FRACTION_BITS // 2)
    n = F.pmod(F.col(slot), F.lit(1 << 36))
    upper = F.pmod(n * F.lit(factor // half), F.lit(half)) * F.lit(half)
    return F.pmod(upper + n * F.lit(factor % half), F.lit(1 << FRACTION_BITS)) / F.lit(float(1 << FRACTION_BITS))


def schedule(sources: DataFrame, block: int) -> DataFrame:
    """``(slot, source_key, round, block, take)``: the mix in order, a block of a source per slot.

    Points find their source by an equal join on the cell of a grid over [0, 1), so there is no
    join of all slots with all sources. Ranks are counted in pieces of 2^13 slots.
    """
    spark = sources.sparkSession
    slots = sources.agg(F.max("all_slots")).first()[0] or 0
    grid = 1 << 12
    cells = sources.where("high > low").select(
        "source_key", "low", "high",
        F.explode(F.sequence(F.floor(F.col("low") * grid), F.least(F.lit(grid - 1), F.floor(F.col("high") * grid)))).alias("cell"),
    )
    points = spark.range(slots).select(F.col("id").alias("slot"), golden_point("id").alias("point"))
    drawn = stash(
        points.withColumn("cell", F.floor(F.col("point") * grid))
        .join(cells, "cell")
        .where("point >= low and point < high")
        .select("slot", "source_key")
    )
    ranked = with_running(
        drawn, "source_key", F.shiftright("slot", 13), ["slot"], {"rank": F.lit(1).cast("long")}
    ).select("slot", "source_key", "rank")
    got = drawn.groupBy("source_key").agg(F.count(F.lit(1)).alias("got"))
    missing = (
        sources.join(got, "source_key", "left")
        .withColumn("got", F.coalesce("got", F.lit(0)).cast("long"))
        .where("got < slots")
        .select(F.lit(slots).cast("long").alias("slot"), "source_key", F.explode(F.sequence("got", F.col("slots") - 1)).alias("rank"))
    )
    size, want, full = F.col("source_size"), F.col("wanted"), F.lit(block)
    length = F.least(full, size - F.col("block") * full)
    left = want - F.col("rounds") * size - F.col("block") * full
    known = sources.select("source_key", "source_size", "wanted", "blocks", "rounds", "slots")
    return (
        ranked.unionByName(missing)
        .join(known, "source_key")
        .where("rank < slots")
        .withColumn("round", F.floor(F.col("rank") / F.col("blocks")))
        .withColumn("block", F.pmod("rank", "blocks"))
        .withColumn("length", length)
        .withColumn("take", F.when(F.col("round") == F.col("rounds"), F.least("length", left)).otherwise(F.col("length")))
        .select("slot", "source_key", "round", "block", "length", "take")
    )


def mix(
    docs: DataFrame,
    keep: list[str],
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST_REPEATS,
    block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """The mix, as its schedule and as what it takes of each document.

    First frame: ``schedule``. Second: ``keep`` columns, ``size``, ``source_key``, ``source_size``,
    ``target``, ``start`` (words before the document in its source) and ``taken`` for every row.
    Null and blank texts have the size 0 and nothing is taken of them; a source of such texts has
    the target 0. Null sources form one source, the last. Repeated rows are documents of their own.
    Empty tables give empty frames.
    """
    narrow = with_pieces(
        docs.select(
            *(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)),
            word_count(text).alias("size"),
            source_key(source).alias("source_key"),
            row_key(*dict.fromkeys([*keep, text])).alias("order"),
        ),
        "order",
        "piece",
    )
    sizes = narrow.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    sources = stash(plan(targets(sizes, weights, most), block))
    slots = stash(schedule(sources, block))
    placed = stash(
        with_running(
            narrow, "source_key", F.col("piece"), ["order"],
            {"start": F.col("size")}, sources.select("source_key", "source_size", "target"),
        ).drop("order", "piece")
    )
    used = slots.groupBy("source_key", "block").agg(
        F.sum((F.col("take") == F.col("length")).cast("long")).alias("times"),
        F.max(F.when(F.col("take") < F.col("length"), F.col("take"))).alias("part"),
    )
    begin = F.greatest(F.lit(0), F.col("start") - F.col("block") * block)
    end = F.least(F.lit(block), F.col("start") + F.col("size") - F.col("block") * block)
    pieces = placed.where("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)))
    )
    of_piece = F.col("times") * (end - begin) + F.greatest(F.lit(0), F.least(end, F.coalesce("part", F.lit(0))) - begin)
    columns = [c for c in placed.columns]
    taken = (
        pieces.join(used, ["source_key", "block"], "left")
        .withColumn("words", F.coalesce(of_piece, F.lit(0)))
        .groupBy(*columns)
        .agg(F.sum("words").alias("taken"))
    )
    nothing = placed.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    result = taken.unionByName(nothing)
    named = [F.col(f"c{i}").alias(c) for i, c in enumerate(keep)]
    return slots, result.select(*named, "size", "source_key", "source_size", "target", "start", "taken")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, taken = mix(table(spark, sf_dir, "documents"), ["doc_id"])
    return taken.select("doc_id", "size", "source_size", "target", "taken")


OP4_SQL = r"""
WITH d AS (SELECT doc_id, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ 	-
]+')) AS BIGINT) AS size,
      coalesce('s' || source, 't') AS k,
      md5(coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-') || '|' ||
          coalesce(strlen(text) || ':' || text, '-')) AS o FROM documents),
s AS (SELECT k, sum(size) AS source_size,
      CASE (row_number() OVER (ORDER BY k) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM d GROUP BY k),
b AS (SELECT k, source_size, w, CAST(3 * source_size AS DOUBLE) AS bound, 3.0 * source_size / w AS r FROM s),
f AS (SELECT x.r, sum(least(y.bound, y.w * x.r)) AS filled FROM (SELECT DISTINCT r FROM b) AS x, b AS y GROUP BY x.r),
z AS (SELECT max(r) AS r FROM f WHERE filled < (SELECT sum(source_size) FROM s)),
l AS (SELECT ((SELECT sum(source_size) FROM s) - coalesce((SELECT sum(bound) FROM b, z WHERE b.r <= z.r), 0))
      / (SELECT sum(w) FROM b, z WHERE z.r IS NULL OR b.r > z.r) AS level),
t AS (SELECT k, CAST(source_size AS BIGINT) AS source_size, least(bound, level * w) AS target FROM b, l),
p AS (SELECT d.*, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS want,
      CAST(coalesce(sum(size) OVER (PARTITION BY k ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
      FROM d JOIN t USING (k))
SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE
  CAST(want // source_size * size + greatest(0, least(start + size, want % source_size) - start) AS BIGINT) END AS taken
FROM p
"""
