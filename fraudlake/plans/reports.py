"""Report tables for dashboards (REP-01..06). Values stay unrounded; ``rounded`` is for files."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.functions.expressions import REPORT_AMOUNT_RANGES, day_name, report_amount_range, share

# The digits of report files.
ROUNDING = {
    "total_amount": 2,
    "avg_fraud_prob": 4,
    "fraud_rate_pct": 2,
    "avg_amount": 2,
    "pct_of_total": 2,
}


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, n) for c, n in ROUNDING.items() if c in df.columns})


def by_card_type(
    predictions: DataFrame,
    segments: DataFrame,
    transactions: DataFrame,
    row_id: str = "TransactionID",
    missing: str | None = "unknown",
) -> DataFrame:
    """Volume, amount and fraud per card type and tier; ``missing=None`` keeps NULL as is."""
    card_type = F.col("card4") if missing is None else F.coalesce(F.col("card4"), F.lit(missing))
    return (
        predictions.select(row_id, "fraud_prob")
        .join(segments.select(row_id, "risk_label"), row_id)
        .join(transactions.select(row_id, "card4", "TransactionAmt", "isFraud"), row_id)
        .groupBy("card4", "risk_label")
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("TransactionAmt").alias("total_amount"),
            F.avg("fraud_prob").alias("avg_fraud_prob"),
            F.sum("isFraud").alias("actual_fraud_count"),
        )
        .withColumn("card_type", card_type)
        .select(
            "card_type",
            "risk_label",
            "transaction_count",
            "total_amount",
            "avg_fraud_prob",
            "actual_fraud_count",
        )
        .orderBy("card_type", "risk_label")
    )


def by_device(
    segments: DataFrame, predictions: DataFrame, row_id: str = "TransactionID"
) -> DataFrame:
    return (
        segments.select(row_id, "DeviceType", "risk_label", "TransactionAmt", "fraud_prob")
        .join(predictions.select(row_id, "isFraud"), row_id)
        .groupBy("DeviceType", "risk_label")
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("TransactionAmt").alias("total_amount"),
            F.avg("fraud_prob").alias("avg_fraud_prob"),
            F.sum("isFraud").alias("actual_fraud_count"),
        )
        .withColumn("device_type", F.coalesce(F.col("DeviceType"), F.lit("unknown")))
        .select(
            "device_type",
            "risk_label",
            "transaction_count",
            "total_amount",
            "avg_fraud_prob",
            "actual_fraud_count",
        )
        .orderBy("device_type", "risk_label")
    )


def fraud_rate_over_time(
    features: DataFrame, transactions: DataFrame, row_id: str = "TransactionID"
) -> DataFrame:
    return (
        features.select(row_id, "tx_dow", "tx_hour")
        .join(transactions.select(row_id, "isFraud", "TransactionAmt"), row_id)
        .groupBy(
            F.col("tx_dow").cast("long").alias("day_of_week"),
            F.col("tx_hour").cast("long").alias("hour_of_day"),
        )
        .agg(
            F.count("*").alias("transaction_count"),
            F.sum("isFraud").alias("fraud_count"),
            share(F.sum("isFraud"), F.count("*")).alias("fraud_rate_pct"),
            F.avg("TransactionAmt").alias("avg_amount"),
        )
        .withColumn("day_name", day_name(F.col("day_of_week")))
        .orderBy("day_of_week", "hour_of_day")
    )


def tier_summary(segments: DataFrame) -> DataFrame:
    """The window runs over the aggregated tiers."""
    total = F.sum("transaction_count").over(Window.partitionBy())
    return (
        segments.groupBy("risk_label", F.col("risk_score").cast("long").alias("risk_score"))
        .agg(
            F.count("*").alias("transaction_count"),
            F.avg("TransactionAmt").alias("avg_amount"),
            F.avg("fraud_prob").alias("avg_fraud_prob"),
        )
        .withColumn("pct_of_total", share(F.col("transaction_count"), total))
        .select(
            "risk_label",
            "risk_score",
            "transaction_count",
            "pct_of_total",
            "avg_amount",
            "avg_fraud_prob",
        )
        .orderBy("risk_score")
    )


def amount_counts(
    df: DataFrame, amount: str = "TransactionAmt", label: str = "isFraud"
) -> DataFrame:
    """Rows per amount range and class, in the order of the ranges."""
    names = [name for _, name in REPORT_AMOUNT_RANGES]
    rank = F.array_position(F.array(*map(F.lit, names)), F.col("amount_range")).cast("int")
    return (
        df.groupBy(report_amount_range(F.col(amount)).alias("amount_range"), F.col(label))
        .agg(F.count("*").alias("transaction_count"))
        .withColumn("range_rank", rank)
        .orderBy("range_rank", label)
    )


def amount_distribution(
    df: DataFrame, amount: str = "TransactionAmt", label: str = "isFraud"
) -> DataFrame:
    """Per amount range and class, ordered by the smallest amount of each group."""
    return (
        df.groupBy(report_amount_range(F.col(amount)).alias("amount_range"), F.col(label))
        .agg(
            F.count("*").alias("transaction_count"),
            F.avg(amount).alias("avg_amount"),
            F.min(amount).alias("_least"),
        )
        .orderBy("_least", label)
        .drop("_least")
    )
