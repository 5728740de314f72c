"""Risk tiers (SEG-05..07)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.functions.expressions import HIGH_BOUND, LOW_BOUND, risk_label, risk_score, share

SEGMENT_COLUMNS = [
    "TransactionID",
    "fraud_prob",
    "risk_label",
    "risk_score",
    "TransactionAmt",
    "card4",
    "DeviceType",
    "tx_hour",
]


def with_tier(
    df: DataFrame, score: str = "fraud_prob", low: float = LOW_BOUND, high: float = HIGH_BOUND
) -> DataFrame:
    return df.withColumn("risk_label", risk_label(F.col(score), low, high)).withColumn(
        "risk_score", risk_score(F.col("risk_label"))
    )


def tier_counts(segments: DataFrame) -> DataFrame:
    """Rows and share per tier; the window runs over the three aggregated rows."""
    counted = segments.groupBy("risk_label").agg(F.count("*").alias("transaction_count"))
    total = F.sum("transaction_count").over(Window.partitionBy())
    return counted.withColumn("pct_of_total", share(F.col("transaction_count"), total))


def risk_segments(
    predictions: DataFrame,
    transactions: DataFrame,
    identity: DataFrame,
    features: DataFrame,
    row_id: str = "TransactionID",
) -> DataFrame:
    """Predictions with their context and tier; all joins share the transaction id as key."""
    return (
        predictions.select(row_id, "fraud_prob")
        .join(transactions.select(row_id, "TransactionAmt", "card4"), row_id)
        .join(identity.select(row_id, "DeviceType"), row_id, "left")
        .join(features.select(row_id, "tx_hour"), row_id, "left")
        .transform(with_tier)
        .select(*SEGMENT_COLUMNS)
    )
