"""Exact class-wise splits, folds and samples (ML-02, ML-03, ML-04, SMP-01).

Rows are ordered by a seeded hash of their id. A split is a set of ranks in that order, and a
set of ranks is described by a few cut-off hashes per class. Finding the cut-offs takes narrow
aggregations; applying them is a join with the small table of cut-offs, one row per class, which
Spark broadcasts or shuffles by its size, and a comparison per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.functions.expressions import hash_order
from fraudlake.session import materialize

PREFIX_DIGITS = 3
GROUP_ROWS = 1 << 16
HASH_DIGITS = 32
# Fixed value: the class weight is a constant of the assumed rate, not a measurement.
FRAUD_RATE = 0.035
POSITIVE_WEIGHT = (1 - FRAUD_RATE) / FRAUD_RATE


def rank_cutoffs(
    df: DataFrame,
    stratum: str | None,
    row_id: str,
    seed: int,
    targets: Callable[[Column], list[Column]],
) -> DataFrame:
    """``(class, cuts)``: per class the order key at each wanted rank, by number of the rank.

    ``targets`` makes the ranks from the class size; rank 0 has no key. Classes that are null have
    no row. Rows are counted by three more leading hash digits in each pass, only in the groups that
    hold a wanted rank, until these have at most 2^16 rows; only those are ranked. Any number of
    classes is possible, and no group that is sorted grows with the table.
    """
    keyed = df.select(
        (F.col(stratum) if stratum else F.lit(0)).alias("class"),
        hash_order(F.col(row_id), seed).alias("key"),
    ).where("class is not null")
    sizes = keyed.groupBy("class").agg(F.count(F.lit(1)).alias("n"))
    ranks = F.array(*[t.cast("long") for t in targets(F.col("n"))])
    open_ = materialize(
        sizes.select("class", "n", F.posexplode(ranks).alias("i", "local"))
        .where("local > 0")
        .withColumn("prefix", F.lit(""))
    )
    digits = 0
    while digits < HASH_DIGITS:
        if (open_.agg(F.max("n")).first()[0] or 0) <= GROUP_ROWS:
            break
        digits += PREFIX_DIGITS
        parents = open_.select("class", "prefix").distinct()
        counted = (
            keyed.withColumn("prefix", F.substring("key", 1, digits - PREFIX_DIGITS))
            .join(parents, ["class", "prefix"])
            .groupBy("class", "prefix", F.substring("key", 1, digits).alias("longer"))
            .agg(F.count(F.lit(1)).alias("_n"))
        )
        upto = F.sum("_n").over(Window.partitionBy("class", "prefix").orderBy("longer"))
        open_ = materialize(
            counted.withColumn("before", upto - F.col("_n"))
            .join(open_.drop("n"), ["class", "prefix"])
            .where("before < local and local <= before + _n")
            .select("class", F.col("_n").alias("n"), "i", (F.col("local") - F.col("before")).alias("local"), F.col("longer").alias("prefix"))
        )
    position = F.row_number().over(Window.partitionBy("class", "prefix").orderBy("key"))
    located = (
        keyed.withColumn("prefix", F.substring("key", 1, digits) if digits else F.lit(""))
        .join(open_.select("class", "prefix").distinct(), ["class", "prefix"])
        .withColumn("local", position.cast("long"))
        .join(open_.drop("n"), ["class", "prefix", "local"])
    )
    cuts = F.map_from_entries(F.collect_list(F.struct("i", "key")))
    return materialize(located.groupBy("class").agg(cuts.alias("cuts")))


def _with_cuts(df: DataFrame, cuts: DataFrame, stratum: str) -> DataFrame:
    named = cuts.select(F.col("class").alias("_class"), F.col("cuts").alias("_cuts"))
    return df.join(named, F.col(stratum) == F.col("_class"), "left").drop("_class")


def first_key(df: DataFrame, row_id: str, seed: int, rank: int) -> str | None:
    """The order key of the row at ``rank``, of the last row if there are fewer; None for rank 0."""
    found = rank_cutoffs(df, None, row_id, seed, lambda n: [F.least(n, F.lit(rank))]).first()
    return found["cuts"].get(0) if found else None


def with_test_flag(
    df: DataFrame,
    label: str = "isFraud",
    row_id: str = "TransactionID",
    test_share: float = 0.2,
    seed: int = 42,
    name: str = "is_test",
) -> DataFrame:
    """Mark round(share * n) rows of every class for the hold-out; rows without a class are not in it."""
    cuts = rank_cutoffs(df, label, row_id, seed, lambda n: [F.floor(n * test_share + 0.5)])
    inside = hash_order(F.col(row_id), seed) <= F.col("_cuts")[0]
    return _with_cuts(df, cuts, label).select(*df.columns, F.coalesce(inside, F.lit(False)).alias(name))


def stratified_split(
    df: DataFrame,
    label: str = "isFraud",
    row_id: str = "TransactionID",
    test_share: float = 0.2,
    seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    flagged = with_test_flag(df, label, row_id, test_share, seed, "_is_test")
    return (
        flagged.where(~F.col("_is_test")).drop("_is_test"),
        flagged.where("_is_test").drop("_is_test"),
    )


def with_fold(
    df: DataFrame,
    label: str = "isFraud",
    row_id: str = "TransactionID",
    folds: int = 3,
    seed: int = 42,
    name: str = "fold",
) -> DataFrame:
    """Fold number 0..k-1; per class the fold sizes differ by at most one."""
    cuts = rank_cutoffs(
        df, label, row_id, seed, lambda n: [F.floor((f + 1) * n / folds) for f in range(folds - 1)]
    )
    key = hash_order(F.col(row_id), seed)
    fold = F.lit(folds - 1)
    for f in reversed(range(folds - 1)):
        fold = F.when(key <= F.col("_cuts")[f], F.lit(f)).otherwise(fold)
    return _with_cuts(df, cuts, label).select(*df.columns, fold.cast("long").alias(name))


def sample_rows(df: DataFrame, n: int, row_id: str = "TransactionID", seed: int = 42) -> DataFrame:
    """Exactly min(n, all) rows, repeatable, picked by a filter and not by a sort of wide rows."""
    cut = first_key(df, row_id, seed, n)
    if cut is None:
        return df.where(F.lit(False))
    return df.where(hash_order(F.col(row_id), seed) <= F.lit(cut))


def with_class_weight(
    df: DataFrame,
    label: str = "isFraud",
    positive_weight: float = POSITIVE_WEIGHT,
    name: str = "class_weight",
) -> DataFrame:
    return df.withColumn(name, F.when(F.col(label) == 1, F.lit(positive_weight)).otherwise(1.0))
