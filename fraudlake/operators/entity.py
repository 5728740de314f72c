"""Per-key statistics on every row: deviation, counts, frequencies (FE-04, 05, 07, 11)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.operators.lookup import attach_by_key

DEFAULT_COUNTS = {"DeviceInfo": "tx_count_device", "P_emaildomain": "tx_count_pdomain"}
DEFAULT_FREQUENCIES = {
    "P_emaildomain": "P_emaildomain_freq",
    "R_emaildomain": "R_emaildomain_freq",
    "DeviceInfo": "DeviceInfo_freq",
}


def _group(df: DataFrame, keys: Sequence[str], *aggregates: Column) -> DataFrame:
    """Aggregate the rows that have all keys; the partial aggregation runs before the shuffle."""
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    return df.where(present).groupBy(*keys).agg(F.count("*").alias("_rows"), *aggregates)


def _own(fit_on: DataFrame | None, own_weights: bool | None) -> bool:
    """Whether the statistics are of the rows themselves: by default if there is no ``fit_on``."""
    return fit_on is None if own_weights is None else own_weights


def with_amount_deviation(
    df: DataFrame,
    key: str = "card1",
    amount: str = "TransactionAmt",
    row_id: str = "TransactionID",
    mean_name: str = "amt_vs_card1_mean",
    zscore_name: str = "amt_vs_card1_zscore",
    fit_on: DataFrame | None = None,
    own_weights: bool | None = None,
) -> DataFrame:
    """Distance of the amount from the key's mean, plain and in sample standard deviations."""
    stats = _group(
        fit_on if fit_on is not None else df,
        [key],
        F.avg(amount).alias("_mean"),
        F.stddev_samp(amount).alias("_std"),
    )
    gap = F.col(amount) - F.col("_mean")
    return attach_by_key(df, stats, [key], "_rows", row_id, _own(fit_on, own_weights)).select(
        *df.columns,
        gap.alias(mean_name),
        (gap / (F.coalesce(F.col("_std"), F.lit(1.0)) + F.lit(1e-8))).alias(zscore_name),
    )


def with_group_count(
    df: DataFrame,
    keys: Sequence[str],
    name: str,
    row_id: str = "TransactionID",
    fit_on: DataFrame | None = None,
    own_weights: bool | None = None,
) -> DataFrame:
    """Rows that share the row's key values; 0 if any key is missing."""
    stats = _group(fit_on if fit_on is not None else df, keys)
    return attach_by_key(df, stats, keys, "_rows", row_id, _own(fit_on, own_weights)).select(
        *df.columns, F.coalesce(F.col("_rows"), F.lit(0)).cast("long").alias(name)
    )


def with_entity_counts(
    df: DataFrame,
    columns: Mapping[str, str] = DEFAULT_COUNTS,
    row_id: str = "TransactionID",
    fit_on: DataFrame | None = None,
    own_weights: bool | None = None,
) -> DataFrame:
    source, own = fit_on if fit_on is not None else df, _own(fit_on, own_weights)
    for column, name in columns.items():
        if column in df.columns:
            df = with_group_count(df, [column], name, row_id, source, own)
    return df


def with_pair_count(
    df: DataFrame,
    keys: Sequence[str] = ("card1", "addr1"),
    name: str = "card1_addr1_count",
    row_id: str = "TransactionID",
    fit_on: DataFrame | None = None,
    own_weights: bool | None = None,
) -> DataFrame:
    return with_group_count(df, keys, name, row_id, fit_on, own_weights)


def with_entity_profile(
    df: DataFrame,
    column: str,
    count_name: str | None,
    frequency_name: str | None,
    row_id: str = "TransactionID",
    fit_on: DataFrame | None = None,
    own_weights: bool | None = None,
) -> DataFrame:
    """Count and share of the row's value from one aggregation and one join."""
    source = fit_on if fit_on is not None else df
    total = source.agg(F.count(column).alias("_total"))
    found = attach_by_key(df, _group(source, [column]), [column], "_rows", row_id, _own(fit_on, own_weights))
    added = []
    if count_name:
        added.append(F.coalesce(F.col("_rows"), F.lit(0)).cast("long").alias(count_name))
    if frequency_name:
        part = F.coalesce(F.col("_rows"), F.lit(0)).cast("double")
        added.append(F.coalesce(F.try_divide(part, total.scalar()), F.lit(0.0)).alias(frequency_name))
    return found.select(*df.columns, *added)


def with_frequencies(
    df: DataFrame,
    columns: Mapping[str, str] = DEFAULT_FREQUENCIES,
    row_id: str = "TransactionID",
    fit_on: DataFrame | None = None,
    own_weights: bool | None = None,
) -> DataFrame:
    """Share of the row's value among the non-missing values; 0.0 for missing or unknown."""
    source, own = fit_on if fit_on is not None else df, _own(fit_on, own_weights)
    for column, name in columns.items():
        if column in df.columns:
            df = with_entity_profile(df, column, None, name, row_id, source, own)
    return df
