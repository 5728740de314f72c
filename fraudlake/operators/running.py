"""Running totals over a whole table without a single-task window (WIN-04)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.session import materialize


def running_totals(
    df: DataFrame, by: str, sums: Mapping[str, Column], descending: bool = False, ties: str | None = None
) -> DataFrame:
    """``df`` plus running sums in the order of the numeric column ``by`` (then ``ties``).

    ``by`` (with ``ties``) must order the rows uniquely. The rows are dealt to ranges of that order
    by a range exchange, which cuts at sampled quantiles, so the ranges are even however the values
    pile up; the copy is written with the number of each row's range. A row's total is that of the
    ranges before its own and of the rows before it there. There are as many ranges as shuffle
    partitions: the window over ranges sees, and the broadcast holds, one row for each.
    """
    order = [F.desc(by) if descending else F.asc(by), *([F.asc(ties)] if ties else [])]
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(
        df.withColumns({f"_{n}": c for n, c in sums.items()})
        .repartitionByRange(ranges, *order)
        .withColumn("_range", F.spark_partition_id())
    )
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_range")
        .agg(*[F.sum(f"_{n}").alias(f"_{n}") for n in sums])
        .select("_range", *[F.coalesce(F.sum(f"_{n}").over(before), F.lit(0)).alias(f"_before_{n}") for n in sums])
    )
    rows = (
        Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return ranged.join(F.broadcast(offsets), "_range").select(
        *df.columns,
        *[(F.sum(f"_{n}").over(rows) + F.col(f"_before_{n}")).alias(n) for n in sums],
    )
