"""Profiling datasets (EDA-01..12, AGG-16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.functions.expressions import (
    report_amount_range,
    share,
    tx_dow,
    tx_hour,
)
from fraudlake.session import materialize

HISTOGRAM_BINS = 60
CORRELATION_CHUNK = 60


def _rate(label: str):
    return (F.avg(label) * 100).alias("fraud_rate_pct")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)).cast("long")
    )


def preview(df: DataFrame, rows: int = 5, row_id: str = "TransactionID") -> DataFrame:
    """The first rows by id."""
    return df.orderBy(row_id).limit(rows)


def class_balance(df: DataFrame, label: str = "isFraud") -> DataFrame:
    """Counts per class with the overall rate and the number of rows per positive."""
    counted = df.groupBy(label).agg(F.count("*").alias("transaction_count"))
    everything = Window.partitionBy()
    positives = F.sum(F.col("transaction_count") * F.col(label)).over(everything)
    total = F.sum("transaction_count").over(everything)
    return counted.select(
        label,
        "transaction_count",
        share(positives, total).alias("fraud_rate_pct"),
        F.floor(F.try_divide(total, positives)).cast("long").alias("imbalance_ratio"),
    ).orderBy(label)


def amount_histogram(
    df: DataFrame, amount: str = "TransactionAmt", label: str = "isFraud", bins: int = HISTOGRAM_BINS
) -> DataFrame:
    """Density of log(1 + amount) per class over the class's own range; bins are numbered from 0.

    Every class has all bins, empty ones with the count and density 0. The ranges, one row per
    class, are joined back to the rows as Spark sees fit; the rows are then counted per (class, bin)
    with a partial aggregation, and the counts meet the grid of bins.
    """
    logged = df.where(F.col(amount).isNotNull() & F.col(label).isNotNull()).select(
        label, F.log1p(amount).alias("x")
    )
    ranges = materialize(
        logged.groupBy(label).agg(
            F.min("x").alias("low"), F.max("x").alias("high"), F.count("*").alias("total")
        )
    )
    width = (F.col("high") - F.col("low")) / bins
    position = F.try_divide((F.col("x") - F.col("low")) * bins, F.col("high") - F.col("low"))
    bin_number = F.least(F.floor(F.coalesce(position, F.lit(0.0))), F.lit(bins - 1))
    counted = (
        logged.join(ranges, label)
        .groupBy(label, bin_number.cast("long").alias("bin"))
        .agg(F.count("*").alias("n"))
    )
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(bins - 1).cast("long"))))
    n = F.coalesce(F.col("n"), F.lit(0))
    return grid.join(counted, [label, "bin"], "left").select(
        label,
        "bin",
        (F.col("low") + F.col("bin") * width).alias("bin_start"),
        n.alias("transaction_count"),
        F.try_divide(n, F.col("total") * width).alias("density"),
    )


def rate_by_amount(df: DataFrame, amount: str = "TransactionAmt", label: str = "isFraud") -> DataFrame:
    """Fraud rate per amount range; negative and missing amounts are in no range."""
    return (
        df.where(F.col(amount) >= 0)
        .groupBy(report_amount_range(F.col(amount)).alias("amt_bucket"))
        .agg(_rate(label), F.min(amount).alias("_least"))
        .orderBy("_least")
        .drop("_least")
    )


def hour_matrix(df: DataFrame, time: str = "TransactionDT", label: str = "isFraud") -> DataFrame:
    """Fraud rate per day (rows) and hour (columns h0 .. h23); the hours are known up front, so
    the pivot needs no extra job."""
    hours = [f"h{h}" for h in range(24)]
    return (
        df.select(
            tx_dow(F.col(time)).alias("tx_dow"),
            F.concat(F.lit("h"), tx_hour(F.col(time)).cast("string")).alias("hour"),
            label,
        )
        .groupBy("tx_dow")
        .pivot("hour", hours)
        .agg(_rate(label))
        .orderBy("tx_dow")
    )


def hourly(df: DataFrame, time: str = "TransactionDT", label: str = "isFraud") -> DataFrame:
    return (
        df.groupBy(tx_hour(F.col(time)).alias("tx_hour"))
        .agg(_rate(label), F.count("*").alias("transaction_count"))
        .orderBy("tx_hour")
    )


def rate_by_category(
    df: DataFrame,
    column: str,
    label: str = "isFraud",
    top: int | None = None,
    at_least: int = 0,
) -> DataFrame:
    """(category, transaction_count, fraud_rate_pct), highest rate first, missing excluded."""
    rated = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("category"))
        .agg(F.count(label).alias("transaction_count"), _rate(label))
        .where(F.col("transaction_count") >= at_least)
        .orderBy(F.desc("fraud_rate_pct"), F.asc("category"))
    )
    return rated.limit(top) if top else rated


def identity_split(df: DataFrame, column: str = "DeviceType", label: str = "isFraud") -> DataFrame:
    """Rows and fraud rate with and without identity data."""
    counted = df.groupBy(F.col(column).isNotNull().alias("has_identity")).agg(
        F.count("*").alias("transaction_count"), _rate(label)
    )
    total = F.sum("transaction_count").over(Window.partitionBy())
    return counted.withColumn("pct_of_total", share(F.col("transaction_count"), total))


def label_correlation(
    df: DataFrame, columns: Sequence[str], label: str = "isFraud"
) -> DataFrame:
    """(feature, correlation) with the label over the rows that have both; NULL for a constant.

    The moments are centred in the aggregation itself (covariance and variances), chunk by
    chunk so that the generated code of one aggregation stays small.
    """
    parts = []
    for start in range(0, len(columns), CORRELATION_CHUNK):
        chunk = list(columns[start : start + CORRELATION_CHUNK])
        values = []
        for c in chunk:
            x, y = F.col(c).cast("double"), F.col(label).cast("double")
            both = x.isNotNull() & y.isNotNull()
            spread = F.stddev_pop(F.when(both, x)) * F.stddev_pop(F.when(both, y))
            values.append(F.try_divide(F.covar_pop(x, y), spread).alias(c))
        parts.append(df.agg(*values).unpivot([], chunk, "feature", "correlation"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def strongest_correlations(correlations: DataFrame, n: int = 10) -> DataFrame:
    """The n largest and the n smallest, one list, largest first."""
    known = correlations.where(F.col("correlation").isNotNull())
    largest = known.orderBy(F.desc("correlation"), F.asc("feature")).limit(n)
    smallest = known.orderBy(F.asc("correlation"), F.asc("feature")).limit(n)
    return largest.unionByName(smallest).orderBy(F.desc("correlation"), F.asc("feature"))
