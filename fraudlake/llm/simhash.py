"""Near-duplicate classes by SimHash, linked through a segment-popcount embedding.

Method. A fingerprint is embedded as the bit counts of its 2-bit segments, 32 counts from 0 to 2.
The Manhattan distance of two embeddings is at most the Hamming distance of the fingerprints. A
link of at most three bits leaves at most one bit of difference in the upper or the lower half, so
the embeddings of that half lie in one grid cell or in two that differ by one step. Every
fingerprint is entered in the home cell of each half and looks into that cell and those one step
up; candidates are thinned by the Manhattan bound and verified by the exact Hamming distance.

Only distinct fingerprints take part, so copies of a text cost one row. All counts fit packed in a
long, and the search is Spark SQL on longs.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.llm.common import stash, table
from fraudlake.llm.simhash_text import fingerprint

PAIRS = 0x5555555555555555
HALF = 0xFFFFFFFF
LANES = 8


def with_fingerprint(docs: DataFrame, keep: list[str], text: str = "text", width: int = 3) -> DataFrame:
    """``keep`` columns and ``fp`` (the 64 bits as a long) for every row; a null text gives 0."""
    names = [f"k{i}" for i in range(len(keep))]
    narrow = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names)), F.col(text).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = (fingerprint(t.as_py(), width) for t in batch.column("text"))
            signed = pa.array([v - (1 << 64) if v >> 63 else v for v in prints], pa.int64())
            kept = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays([*kept, signed], names=[*names, "fp"])

    schema = ", ".join([*(f"{n} {narrow.schema[n].dataType.simpleString()}" for n in names), "fp long"])
    out = narrow.mapInArrow(run, schema)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "fp")


def segment_counts(fp: Column) -> Column:
    """The 32 counts of 2-bit segments, each in its own two bits."""
    upper = F.shiftrightunsigned(fp, 1)
    one = fp.bitwiseXOR(upper).bitwiseAND(F.lit(PAIRS))
    two = fp.bitwiseAND(upper).bitwiseAND(F.lit(PAIRS))
    return F.shiftleft(two, 1).bitwiseOR(one)


def manhattan_bound(a: Column, b: Column) -> Column:
    """Manhattan distance of two packed embeddings.

    Counts of 0, 1, 2 are spread to unary (00, 01, 11), where the distance is a Hamming distance.
    """

    def unary(x: Column) -> Column:
        return x.bitwiseOR(F.shiftrightunsigned(x, 1).bitwiseAND(F.lit(PAIRS)))

    return F.bit_count(unary(a).bitwiseXOR(unary(b)))


def linked_pairs(prints: DataFrame, max_distance: int = 3) -> DataFrame:
    """Pairs ``(a, b)`` of distinct values of ``fp`` with at most ``max_distance`` (0 to 3) differing bits.

    Each pair comes once, in no fixed direction. Nulls take no part.
    """
    if not 0 <= max_distance <= 3:
        raise ValueError("halves with one step of difference find links of 0 to 3 bits")
    counted = prints.where("fp is not null").select("fp").distinct().withColumn("counts", segment_counts(F.col("fp")))
    halves = F.array(
        F.struct(F.lit(0).alias("half"), F.shiftrightunsigned("counts", 32).alias("cell")),
        F.struct(F.lit(1).alias("half"), F.col("counts").bitwiseAND(F.lit(HALF)).alias("cell")),
    )
    homes = counted.select("fp", "counts", F.explode(halves).alias("h")).select("fp", "counts", "h.half", "h.cell")
    # One step up in a segment: adding 1 to a count below 2. A step down is the other one's step up.
    steps = F.array(
        *(F.when(F.col("cell").bitwiseAND(F.lit(2 << 2 * i)) == 0, F.col("cell") + F.lit(1 << 2 * i)) for i in range(16))
    )
    looks = homes.select(
        F.col("fp").alias("a"),
        F.col("counts").alias("counts_a"),
        F.col("half").alias("half_a"),
        F.col("cell").alias("home_a"),
        F.explode(F.concat(F.array(F.col("cell")), F.array_compact(steps))).alias("cell_a"),
    )
    near = (
        (F.col("half") == F.col("half_a"))
        & (F.col("cell") == F.col("cell_a"))
        # Both at home in the cell: the smaller one looks.
        & ((F.col("home_a") != F.col("cell")) | (F.col("a") < F.col("fp")))
        & (manhattan_bound(F.col("counts_a"), F.col("counts")) <= max_distance)
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("fp"))) <= max_distance)
        # What the upper half has found the lower half leaves out.
        & (
            (F.col("half") == 0)
            | (
                manhattan_bound(
                    F.shiftrightunsigned("counts_a", 32), F.shiftrightunsigned("counts", 32)
                )
                > 1
            )
        )
    )
    return looks.join(homes, near).select("a", F.col("fp").alias("b"))


def components(pairs: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of ``(a, b)``: the label is the smallest node reachable.

    Rounds of two steps: take the smallest label among the neighbours, then the label of one's
    label, so the number of rounds grows with the logarithm of a chain. Every round is written to
    the shared folder. In the second step many nodes ask for one label; they are dealt to lanes.
    """
    edges = stash(pairs.union(pairs.select("b", "a")).toDF("node", "other"))
    labels = stash(edges.groupBy("node").agg(F.least(F.min("node"), F.min("other")).alias("label")))
    lanes = F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))).alias("lane")
    while True:
        seen = labels.select(F.col("node").alias("other"), F.col("label").alias("theirs"))
        least = edges.join(seen, "other").groupBy("node").agg(F.min("theirs").alias("least"))
        hooked = labels.join(least, "node").select(
            "node", F.col("label").alias("old"), F.least("label", "least").alias("mid")
        )
        target = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"), lanes)
        new = stash(
            hooked.withColumn("lane", F.pmod(F.xxhash64("node"), F.lit(LANES)).cast("int"))
            .join(target, ["mid", "lane"])
            .select("node", F.least("mid", "far").alias("label"), "old")
        )
        labels = new.select("node", "label")
        if new.where("label <> old").isEmpty():
            return labels


def near_duplicate_classes(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 3,
    max_distance: int = 3,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id``, ``keep`` columns, ``fp``, ``class`` and ``component`` for every row of ``docs``.

    ``class`` is the smallest fingerprint reachable over links, as a signed number, and ``component``
    the smallest id among the rows of the class. Null ids are never the smallest; a class with no id
    at all has the component null. Repeated rows stay repeated. Null and blank texts have the
    fingerprint 0 and are linked like any other. An empty table gives an empty result.
    """
    kept = [doc_id, *keep]
    named = docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(kept)), F.col(text).alias("text"))
    prints = stash(with_fingerprint(named, [f"c{i}" for i in range(len(kept))], "text", width))
    first = prints.groupBy("fp").agg(F.min("c0").alias("first_id"))
    labels = components(stash(linked_pairs(prints, max_distance))).withColumnRenamed("node", "fp")
    smallest = stash(labels.join(first, "fp").groupBy("label").agg(F.min("first_id").alias("smallest")))
    linked = labels.join(smallest, "label").select("fp", "label", "smallest")
    # Both written, so that the joins are of two plain tables: there Spark splits the partition of a
    # class that very many fingerprints have, and of a fingerprint that very many rows have.
    of_class = stash(
        first.join(linked, "fp", "left").select(
            F.col("fp").alias("_fp"),
            F.coalesce("label", "fp").alias("class"),
            F.coalesce("smallest", "first_id").alias("component"),
        )
    )
    found = prints.join(of_class, F.col("fp") == F.col("_fp"))
    return found.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(kept)), "fp", "class", "component")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_duplicate_classes(table(spark, sf_dir, "documents"))
    return classes.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )
