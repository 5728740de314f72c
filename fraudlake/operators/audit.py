"""Missing-value audit and what follows from it (AGG-02, PRJ-02, PRJ-03, PRJ-04, EDA-08)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The share of missing values above which a column is dropped, and the text
# columns that are dropped once encoded.
SPARSE_THRESHOLD = 0.80
ENCODED_STRINGS = [f"M{i}" for i in range(1, 10)] + [
    "P_emaildomain",
    "R_emaildomain",
    "DeviceInfo",
]


def nan_to_null(df: DataFrame) -> DataFrame:
    """NULL is the only missing value inside the library."""
    columns = []
    for field in df.schema.fields:
        column = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            column = F.when(~F.isnan(column), column).alias(field.name)
        columns.append(column)
    return df.select(*columns)


def null_rate_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(col, null_count, total_rows, null_pct) for every column, in one scan of the table.

    The partial aggregate of a task is one row of counters, so the single exchange carries one
    row per task whatever the table size.
    """
    columns = list(columns or df.columns)
    counts = df.agg(
        F.count("*").alias("total_rows"), *[F.count(F.col(c)).alias(c) for c in columns]
    )
    pairs = ", ".join("'{0}', `{1}`".format(c.replace("'", "\\'"), c) for c in columns)
    return counts.selectExpr(
        "total_rows", f"stack({len(columns)}, {pairs}) AS (col, filled)"
    ).select(
        "col",
        (F.col("total_rows") - F.col("filled")).alias("null_count"),
        "total_rows",
        F.round(
            F.try_divide((F.col("total_rows") - F.col("filled")) * 100.0, F.col("total_rows")), 2
        ).alias("null_pct"),
    )


def sparse_column_ranking(
    audit: DataFrame, prefix: str = "V", threshold: float = SPARSE_THRESHOLD
) -> DataFrame:
    """Columns of the prefix by null share, with the decision to keep or drop each."""
    return (
        audit.where(F.col("col").startswith(prefix))
        .withColumn("dropped", F.coalesce(F.col("null_pct") > threshold * 100, F.lit(False)))
        .orderBy(F.desc("null_pct"), "col")
    )


def sparse_columns(
    audit: DataFrame, prefix: str = "V", threshold: float = SPARSE_THRESHOLD
) -> list[str]:
    """Names to drop; the audit has one row per column, so the list is as short as the schema."""
    ranked = sparse_column_ranking(audit, prefix, threshold)
    return [row["col"] for row in ranked.where("dropped").select("col").collect()]


def drop_sparse_columns(
    df: DataFrame,
    prefix: str = "V",
    threshold: float = SPARSE_THRESHOLD,
    audit: DataFrame | None = None,
) -> DataFrame:
    """Drop the prefix columns whose null share is strictly above the threshold."""
    if audit is None:
        audit = null_rate_audit(df, [c for c in df.columns if c.startswith(prefix)] or None)
    return df.drop(*sparse_columns(audit, prefix, threshold))


def drop_encoded_strings(df: DataFrame, names: Sequence[str] = tuple(ENCODED_STRINGS)) -> DataFrame:
    return df.drop(*names)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        field.name
        for field in df.schema.fields
        if isinstance(field.dataType, T.NumericType) and field.name not in exclude
    ]


def narrow_types(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Smaller types for a table about to be written; values must fit (ANSI cast)."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})
