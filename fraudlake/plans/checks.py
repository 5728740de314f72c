"""Data-quality checks (REP-08, SNK-12, JN-08, SET-01, AGG-03)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fraudlake.functions.expressions import share
from fraudlake.sources.readers import count_rows


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tbl, rows) for each table."""
    counted = [count_rows(df, name) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counted)


def class_share(df: DataFrame, label: str = "isFraud") -> DataFrame:
    counted = df.groupBy(label).agg(F.count("*").alias("transaction_count"))
    total = F.sum("transaction_count").over(Window.partitionBy())
    return counted.withColumn(
        "pct_of_total", share(F.col("transaction_count"), total)
    ).orderBy(label)


def identity_coverage(
    transactions: DataFrame, identity: DataFrame, row_id: str = "TransactionID"
) -> DataFrame:
    """Share of the transactions that have an identity row; only the ids are read."""
    known = identity.select(row_id, F.lit(1).alias("_known"))
    return (
        transactions.select(row_id)
        .join(known, row_id, "left")
        .agg(share(F.count("_known"), F.count(row_id)).alias("identity_coverage_pct"))
    )


def null_share(df: DataFrame, column: str) -> DataFrame:
    return df.agg(
        share(F.count("*") - F.count(column), F.count("*")).alias("null_pct")
    ).select(F.lit(column).alias("col"), "null_pct")


def verify_report(
    spark: SparkSession, path: str, name: str, first_column: str | None = None
) -> DataFrame:
    """(report, present, rows, first_value): a missing report is a row with present = false."""
    try:
        report = spark.read.csv(path, header=True)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.range(1).select(
            F.lit(name).alias("report"),
            F.lit(False).alias("present"),
            F.lit(0).cast("long").alias("rows"),
            F.lit(None).cast("string").alias("first_value"),
        )
    first = F.first(F.col(first_column)) if first_column in report.columns else F.lit(None)
    return report.agg(
        F.count("*").alias("rows"), first.cast("string").alias("first_value")
    ).select(F.lit(name).alias("report"), F.lit(True).alias("present"), "rows", "first_value")


def require_row_ids(df: DataFrame, row_id: str, name: str) -> None:
    """Raise unless every row has an id of its own.

    Only ids are counted, combined before the shuffle; a table bucketed by the id is not shuffled.
    """
    found = (
        df.groupBy(row_id)
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(
            F.sum(F.when(F.col(row_id).isNull(), F.col("rows"))).alias("missing"),
            F.count_if((F.col("rows") > 1) & F.col(row_id).isNotNull()).alias("repeated"),
        )
        .first()
    )
    if found["missing"] or found["repeated"]:
        raise ValueError(
            f"{name}: {found['missing'] or 0} rows without {row_id}, {found['repeated']} ids that occur again"
        )
