"""Bring per-key statistics back to the rows when a few keys may hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 256
SPREAD = 4096


def attach_by_key(
    rows: DataFrame,
    stats: DataFrame,
    keys: Sequence[str],
    weight: str,
    row_id: str,
    own_weights: bool = True,
) -> DataFrame:
    """Left join ``rows`` with ``stats`` (one row per key, ``weight`` = rows of that key).

    The heaviest keys, four per shuffle partition and at least 256, are broadcast: that side is
    bounded whatever the data. Their rows, and rows without a key, need no partner any more and are
    spread over the shuffle by a hash of the row id. Every key left for the shuffled join holds less
    than a quarter of an even partition, so no task gets a hot group, and no key is dropped.

    With ``own_weights=False`` the statistics are of other rows, and the heavy keys are counted
    among ``rows``, where a key that the statistics lack may be heavy too.
    """
    keys = list(keys)
    values = [c for c in stats.columns if c not in keys]
    packed = F.struct(*values)
    most = max(HOT_KEYS, 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    known = stats.select(*keys, packed.alias("_hot"), F.col(weight).alias("_weight"))
    if not own_weights:
        counted = rows.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_weight"))
        heavy = counted.orderBy(F.desc("_weight"), *keys).limit(most)
        known = heavy.join(known.drop("_weight"), keys, "left")
    hot = known.orderBy(F.desc("_weight"), *keys).limit(most).select(*keys, "_hot", F.lit(True).alias("_heavy"))
    # Always 0, but from a column: a literal would be folded out of the join keys, and the
    # rows would then be shuffled by the key alone.
    lane_zero = F.least(F.col(weight), F.lit(0).cast("long"))
    cold = stats.select(*keys, lane_zero.alias("_lane"), packed.alias("_cold"))

    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    lane = F.when(complete & F.col("_heavy").isNull(), F.lit(0).cast("long")).otherwise(
        F.pmod(F.xxhash64(F.col(row_id)), F.lit(SPREAD)) + 1
    )
    placed = rows.join(F.broadcast(hot), keys, "left").withColumn("_lane", lane)
    joined = placed.join(cold, [*keys, "_lane"], "left")
    return joined.select(
        *rows.columns,
        *[F.coalesce(F.col("_hot")[v], F.col("_cold")[v]).alias(v) for v in values],
    )
