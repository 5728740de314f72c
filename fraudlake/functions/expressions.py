"""Column expressions: everything here is row-local and stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket edges, labels, bounds and codes that results are compared by.
FEATURE_AMOUNT_BUCKETS = [
    (10.0, "<10"),
    (50.0, "10-50"),
    (200.0, "50-200"),
    (1000.0, "200-1000"),
    (float("inf"), ">1000"),
]
REPORT_AMOUNT_RANGES = [
    (10.0, "<$10"),
    (50.0, "$10-$50"),
    (200.0, "$50-$200"),
    (1000.0, "$200-$1000"),
    (None, ">$1000"),
]
CALIBRATION_BUCKETS = [
    (0.10, "0.00-0.10"),
    (0.20, "0.10-0.20"),
    (0.30, "0.20-0.30"),
    (0.50, "0.30-0.50"),
    (0.70, "0.50-0.70"),
    (None, "0.70+"),
]
DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
TIER_SCORES = {"Low": 1, "Medium": 2, "High": 3}
LOW_BOUND = 0.30
HIGH_BOUND = 0.70
HOUR = 3600
DAY = 86400


def _ladder(value: Column, steps: Sequence[tuple[float | None, str]]) -> Column:
    """Label of the first upper edge above ``value``; NULL falls to the open last step."""
    result = None
    for edge, label in steps:
        if edge is None:
            return result.otherwise(F.lit(label))
        condition = value < F.lit(edge)
        result = F.when(condition, label) if result is None else result.when(condition, label)
    return result


def tx_hour(time: Column) -> Column:
    return F.pmod(F.floor(time / HOUR), F.lit(24)).cast("long")


def tx_dow(time: Column) -> Column:
    """Day index modulo 7; the origin is arbitrary because time is an offset."""
    return F.pmod(F.floor(time / DAY), F.lit(7)).cast("long")


def tx_dom(time: Column) -> Column:
    return (F.pmod(F.floor(time / DAY), F.lit(30)) + 1).cast("long")


def feature_amount_bucket(amount: Column) -> Column:
    """Left-closed bucket of the amount; negative and missing amounts are labelled ``nan``."""
    inside = _ladder(amount, FEATURE_AMOUNT_BUCKETS)
    return F.coalesce(F.when(amount >= 0, inside), F.lit("nan"))


def report_amount_range(amount: Column) -> Column:
    """Report range of the amount; a missing amount lands in the last range."""
    return _ladder(amount, REPORT_AMOUNT_RANGES)


def calibration_bucket(score: Column) -> Column:
    return _ladder(score, CALIBRATION_BUCKETS)


def card_amount_bucket(card: Column, amount: Column) -> Column:
    return F.concat(F.coalesce(card, F.lit("unknown")), F.lit("_"), feature_amount_bucket(amount))


def flag_code(flag: Column) -> Column:
    """1 for T/true, 0 for F/false, -1 for anything else; takes string and boolean columns."""
    text = flag.cast("string")
    return (
        F.when(text.isin("T", "true"), F.lit(1))
        .when(text.isin("F", "false"), F.lit(0))
        .otherwise(F.lit(-1))
        .cast("long")
    )


def risk_label(score: Column, low: float = LOW_BOUND, high: float = HIGH_BOUND) -> Column:
    """Low below ``low``, High above ``high``, else Medium (both bounds and NULL included)."""
    return F.when(score < low, "Low").when(score > high, "High").otherwise("Medium")


def risk_score(label: Column) -> Column:
    result = None
    for name, value in TIER_SCORES.items():
        result = (
            F.when(label == name, value) if result is None else result.when(label == name, value)
        )
    return result.cast("long")


def day_name(day: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in DAY_NAMES]), (day + 1).cast("int"))


def hash_order(row_id: Column, seed: int) -> Column:
    """A seeded pseudo-random order key: hex digits, uniform, equal in every engine with md5."""
    return F.md5(F.concat(row_id.cast("string"), F.lit(f":{seed}")))


def share(part: Column, whole: Column, scale: float = 100.0) -> Column:
    """``scale * part / whole`` that gives NULL on an empty whole."""
    return F.try_divide(part * F.lit(scale), whole)
