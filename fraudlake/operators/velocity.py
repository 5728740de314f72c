"""Trailing event counts per key (FE-03)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from fraudlake.functions.expressions import DAY, HOUR
from fraudlake.session import materialize

DEFAULT_WINDOWS = {"tx_count_card1_1h": HOUR, "tx_count_card1_24h": DAY}
BLOCK_WINDOWS = 4
LIGHT_ROWS = 1 << 16  # of one key in one time block, that a task may order by themselves


def trailing_counts(
    df: DataFrame,
    key: str = "card1",
    time: str = "TransactionDT",
    row_id: str = "TransactionID",
    windows: Mapping[str, int] = DEFAULT_WINDOWS,
) -> DataFrame:
    """(row_id, one count per window) for the rows that have a key and a time.

    A row counts the rows of its key at most W seconds older, and those of the same second
    with a smaller id. Time is cut into blocks of 4 windows, where the rows of the last window of
    a block are also given to the next block. Rows per (key, block) are counted first: keys with
    at most ``LIGHT_ROWS`` rows in every block need one shuffle by key and block, and the others,
    which are few as each has so many rows, are split further (``_counts_by_cell``).
    """
    longest = max(windows.values())
    own, blocks = _blocks(time, BLOCK_WINDOWS * longest, longest)
    rows = df.select(row_id, key, time).where(F.col(key).isNotNull() & F.col(time).isNotNull())
    placed = rows.withColumn("_own", own).withColumn("_block", F.explode(blocks))
    heavy = materialize(
        placed.groupBy(key, "_block")
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > LIGHT_ROWS)
        .select(key)
        .distinct()
    )
    split = not heavy.isEmpty()
    if split:
        placed = placed.join(F.broadcast(heavy), key, "left_anti")
    # The order of the ranks is also that of the sums, so both windows share one sort.
    rank = F.row_number().over(Window.partitionBy(key, "_block", time).orderBy(row_id)) - 1
    by_time = Window.partitionBy(key, "_block").orderBy(time)
    counts = (
        placed.withColumn("_rank", rank)
        .withColumns({n: _trailing(F.count(row_id), by_time, w) for n, w in windows.items()})
        .where(F.col("_block") == F.col("_own"))
        .select(row_id, *[(F.col(n) + F.col("_rank")).cast("long").alias(n) for n in windows])
    )
    if not split:
        return counts
    dense = rows.join(F.broadcast(heavy), key, "left_semi")
    return counts.unionByName(_counts_by_cell(dense, key, time, row_id, windows))


def _blocks(time: str, size: int, tail: int) -> tuple[Column, Column]:
    """The block of a time, and all blocks it is given to: also the next one in the last ``tail`` seconds."""
    own = F.floor(F.col(time) / size)
    late = F.col(time) - own * size >= size - tail
    return own, F.when(late, F.array(own, own + 1)).otherwise(F.array(own))


def _trailing(amount: Column, by_time: WindowSpec, seconds: int) -> Column:
    """``amount`` of the earlier rows at most so many seconds older.

    The difference of two running totals: a frame that moves at both ends is summed anew for each row.
    """
    before = by_time.rangeBetween(Window.unboundedPreceding, -1)
    older = by_time.rangeBetween(Window.unboundedPreceding, -seconds - 1)
    return F.coalesce(amount.over(before), F.lit(0)) - F.coalesce(amount.over(older), F.lit(0))


def _counts_by_cell(
    df: DataFrame, key: str, time: str, row_id: str, windows: Mapping[str, int]
) -> DataFrame:
    """The counts where no group grows with the share of one key, however ids run:

    * rows are dealt to ranges of the id, cut at sampled quantiles, and written narrow; they are
      folded into cells (key, second, range), so a second with very many rows is split evenly;
    * the trailing sums run over seconds inside the time blocks: a block has at most as many
      rows as seconds;
    * inside a second, whole ranges are added up, one row each, and only the rows of one cell
      are ranked by id.
    """
    longest = max(windows.values())
    own, blocks = _blocks(time, BLOCK_WINDOWS * longest, longest)
    second, cell = [key, time], [key, time, "_chunk"]

    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = materialize(
        df.repartitionByRange(ranges, row_id).withColumn("_chunk", F.spark_partition_id())
    ).repartition(*cell)
    # Counting the ids keeps the columns of both uses of ``rows`` equal, so they share one
    # exchange.
    cells = rows.groupBy(*cell).agg(F.count(row_id).alias("_n"))

    seconds = cells.groupBy(*second).agg(F.sum("_n").alias("_n"))
    placed = seconds.withColumn("_own", own).withColumn("_block", F.explode(blocks))
    by_time = Window.partitionBy(key, "_block").orderBy(time)
    sums = (
        placed.select(
            *second,
            "_own",
            "_block",
            *[_trailing(F.sum("_n"), by_time, w).alias(name) for name, w in windows.items()],
        )
        .where(F.col("_block") == F.col("_own"))
        .drop("_own", "_block")
    )
    earlier_ids = Window.partitionBy(*second).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    ties = F.coalesce(F.sum("_n").over(earlier_ids), F.lit(0))
    of_cell = cells.withColumn("_ties", ties).drop("_n").join(sums, second)

    rank = F.row_number().over(Window.partitionBy(*cell).orderBy(row_id)) - 1
    return (
        rows.withColumn("_rank", rank)
        .join(of_cell, cell)
        .select(
            row_id,
            *[(F.col(n) + F.col("_ties") + F.col("_rank")).cast("long").alias(n) for n in windows],
        )
    )


def with_velocity(
    df: DataFrame,
    key: str = "card1",
    time: str = "TransactionDT",
    row_id: str = "TransactionID",
    windows: Mapping[str, int] = DEFAULT_WINDOWS,
) -> DataFrame:
    """``df`` plus the trailing counts; a row without a key gets 0."""
    counts = trailing_counts(df, key, time, row_id, windows)
    return df.join(counts, row_id, "left").fillna(0, subset=list(windows))
