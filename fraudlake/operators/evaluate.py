"""Exact evaluation of scores (ML-10..13, 15, 16, SEG-01..04).

Everything starts from one aggregation of the rows to (score, positives, negatives), combined
before the shuffle and written once; the ordered sums then run over the distinct scores.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.functions.expressions import (
    HIGH_BOUND,
    LOW_BOUND,
    calibration_bucket,
    share,
)
from fraudlake.operators.running import running_totals
from fraudlake.session import materialize

# The bounds of the quality gate.
AUC_BOUNDS = [0.80, 0.85, 0.88]


def score_counts(df: DataFrame, label: str = "isFraud", score: str = "fraud_prob") -> DataFrame:
    """(threshold, positives, negatives) per distinct score."""
    return (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("threshold"))
        .agg(
            F.count_if(F.col(label) == 1).alias("positives"),
            F.count_if(F.col(label) != 1).alias("negatives"),
        )
    )


def _curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """(threshold, positives, negatives, tp, fp, all_positives, all_negatives)."""
    counts = materialize(score_counts(df, label, score))
    sums = {"tp": F.col("positives"), "fp": F.col("negatives")}
    totals = counts.agg(F.sum("positives"), F.sum("negatives")).first()
    return running_totals(counts, "threshold", sums, descending=True).withColumns(
        {
            name: F.lit(total or 0).cast("long")
            for name, total in zip(("all_positives", "all_negatives"), totals)
        }
    )


def pr_curve(df: DataFrame, label: str = "isFraud", score: str = "fraud_prob") -> DataFrame:
    """Precision and recall of ``score >= threshold`` for every distinct score."""
    return _curve(df, label, score).select(
        "threshold",
        "tp",
        "fp",
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide(F.col("tp"), F.col("all_positives")).alias("recall"),
    )


def _area(curve: DataFrame) -> list[Column]:
    above = F.col("tp") - F.col("positives") / 2
    auc = F.try_divide(
        F.sum(above * F.col("negatives")),
        F.first("all_positives").cast("double") * F.first("all_negatives"),
    )
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    average = F.try_divide(F.sum(precision * F.col("positives")), F.first("all_positives"))
    return [auc.alias("auc_roc"), average.alias("avg_precision")]


def auc_roc(df: DataFrame, label: str = "isFraud", score: str = "fraud_prob") -> DataFrame:
    """Probability that a positive outranks a negative, ties counted half."""
    curve = _curve(df, label, score)
    return curve.agg(_area(curve)[0])


def average_precision(df: DataFrame, label: str = "isFraud", score: str = "fraud_prob") -> DataFrame:
    """Step sum of precision over recall, without interpolation."""
    curve = _curve(df, label, score)
    return curve.agg(_area(curve)[1])


def _report(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    def ratio(top: Column, bottom: Column) -> Column:
        return F.coalesce(F.try_divide(top.cast("double"), bottom), F.lit(0.0))

    return {
        "precision_fraud": ratio(tp, tp + fp),
        "recall_fraud": ratio(tp, tp + fn),
        "f1_fraud": ratio(2 * tp, 2 * tp + fp + fn),
        "precision_legit": ratio(tn, tn + fn),
        "recall_legit": ratio(tn, tn + fp),
        "f1_legit": ratio(2 * tn, 2 * tn + fp + fn),
        "support_fraud": tp + fn,
        "support_legit": tn + fp,
    }


def _quadrants(predicted: Column, positives: Column, negatives: Column) -> dict[str, Column]:
    def total(condition: Column, count: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, count).otherwise(0)), F.lit(0))

    return {
        "tp": total(predicted, positives),
        "fp": total(predicted, negatives),
        "fn": total(~predicted, positives),
        "tn": total(~predicted, negatives),
    }


def classification_report(
    df: DataFrame, label: str = "isFraud", score: str = "fraud_prob", threshold: float = 0.5
) -> DataFrame:
    """Precision, recall, F1 and support of both classes in one conditional aggregation."""
    predicted = F.col(score) >= threshold
    positive = (F.col(label) == 1).cast("long")
    cells = df.agg(
        *[c.alias(n) for n, c in _quadrants(predicted, positive, 1 - positive).items()]
    )
    parts = _report(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    return cells.select(*[c.alias(n) for n, c in parts.items()])


def confusion_matrix(
    df: DataFrame, label: str = "isFraud", score: str = "fraud_prob", threshold: float = 0.5
) -> DataFrame:
    """One row per actual class, one column per predicted class."""
    predicted = (F.col(score) >= threshold).cast("long")
    return df.groupBy(F.col(label).cast("long").alias("actual")).agg(
        F.count_if(predicted == 0).alias("predicted_0"),
        F.count_if(predicted == 1).alias("predicted_1"),
    )


def metrics_row(
    df: DataFrame, label: str = "isFraud", score: str = "fraud_prob", threshold: float = 0.5
) -> DataFrame:
    """All metrics of one scored table in one row, from one pass over the rows."""
    curve = _curve(df, label, score)
    cells = _quadrants(F.col("threshold") >= threshold, F.col("positives"), F.col("negatives"))
    summed = curve.agg(*_area(curve), *[c.alias(n) for n, c in cells.items()])
    parts = _report(F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn"))
    matrix = F.array(F.array("tn", "fp"), F.array("fn", "tp"))
    return summed.select(
        "auc_roc",
        "avg_precision",
        *[c.alias(n) for n, c in parts.items()],
        matrix.alias("confusion_matrix"),
    )


METRIC_NAMES = [
    "auc_roc",
    "avg_precision",
    "precision_fraud",
    "recall_fraud",
    "f1_fraud",
    "precision_legit",
    "recall_legit",
    "f1_legit",
    "support_fraud",
    "support_legit",
]


def metrics_long(metrics: DataFrame) -> DataFrame:
    """(metric_name, value) of the plain numbers in a metrics row."""
    return metrics.select(*[F.col(n).cast("double").alias(n) for n in METRIC_NAMES]).unpivot(
        [], METRIC_NAMES, "metric_name", "value"
    )


def quality_gate(metrics: DataFrame) -> DataFrame:
    """The AUC and the lowest bound it stays below (``below_0.85``), NULL if it passes them all."""
    missed = F.array_compact(F.array(*[F.when(F.col("auc_roc") < b, F.lit(b)) for b in AUC_BOUNDS]))
    band = F.concat(F.lit("below_"), F.format_string("%.2f", F.array_min(missed)))
    return metrics.select("auc_roc", F.when(F.size(missed) > 0, band).alias("band"))


def calibration_table(df: DataFrame, label: str = "isFraud", score: str = "fraud_prob") -> DataFrame:
    """Rows, positives and actual rate per score bucket."""
    return (
        df.groupBy(calibration_bucket(F.col(score)).alias("prob_bucket"))
        .agg(F.count("*").alias("count"), F.sum(label).alias("actual_fraud"))
        .withColumn("actual_fraud_rate_pct", share(F.col("actual_fraud"), F.col("count")))
        .orderBy("prob_bucket")
    )


def f1_optimal_threshold(df: DataFrame, label: str = "isFraud", score: str = "fraud_prob") -> DataFrame:
    """Threshold with the best F1, the lowest one on a tie."""
    p, r = F.col("precision"), F.col("recall")
    return (
        pr_curve(df, label, score)
        .withColumn("f1", 2 * p * r / (p + r + F.lit(1e-9)))
        .orderBy(F.desc("f1"), F.asc("threshold"))
        .limit(1)
        .select(F.col("threshold").alias("f1_optimal_threshold"), "f1")
    )


def cost_optimal_threshold(
    df: DataFrame,
    label: str = "isFraud",
    score: str = "fraud_prob",
    fn_cost: int = 10,
    fp_cost: int = 1,
) -> DataFrame:
    """Threshold with the lowest cost of misses and false alarms, the lowest one on a tie."""
    missed = F.col("all_positives") - F.col("tp")
    return (
        _curve(df, label, score)
        .withColumn("cost", missed * fn_cost + F.col("fp") * fp_cost)
        .orderBy(F.asc("cost"), F.asc("threshold"))
        .limit(1)
        .select(F.col("threshold").alias("cost_optimal_threshold"), "cost")
    )


def threshold_analysis(
    df: DataFrame,
    label: str = "isFraud",
    score: str = "fraud_prob",
    fn_cost: int = 10,
    fp_cost: int = 1,
) -> DataFrame:
    """One row: both optimal thresholds, taken from one curve, and the business bounds."""
    p, r = F.col("precision"), F.col("recall")
    precise = _curve(df, label, score).withColumns(
        {
            "precision": F.col("tp") / (F.col("tp") + F.col("fp")),
            "recall": F.try_divide(F.col("tp"), F.col("all_positives")),
            "cost": (F.col("all_positives") - F.col("tp")) * fn_cost + F.col("fp") * fp_cost,
        }
    )
    ranked = precise.withColumn("f1", 2 * p * r / (p + r + F.lit(1e-9)))
    # min over (measure, threshold) pairs: the lower threshold wins a tie.
    return ranked.agg(
        F.min(F.struct((-F.col("f1")).alias("m"), "threshold"))["threshold"].alias(
            "f1_optimal_threshold"
        ),
        F.min(F.struct("cost", "threshold"))["threshold"].alias("cost_optimal_threshold"),
    ).withColumns({"business_low": F.lit(LOW_BOUND), "business_high": F.lit(HIGH_BOUND)})
