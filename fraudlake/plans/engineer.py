"""The full feature table (FE-13)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.functions import expressions as X
from fraudlake.operators.audit import drop_encoded_strings, drop_sparse_columns, narrow_types
from fraudlake.operators.encoding import with_flag_codes, with_label_codes
from fraudlake.operators.entity import (
    with_amount_deviation,
    with_entity_profile,
    with_pair_count,
)
from fraudlake.operators.impute import exact_medians, impute, median_targets
from fraudlake.operators.velocity import DEFAULT_WINDOWS, trailing_counts
from fraudlake.plans.checks import require_row_ids

ROW_ID = "TransactionID"

# Types of the persisted table; queries compute in long and double.
STORED_TYPES = {
    **{c: "tinyint" for c in ("tx_hour", "tx_dow", "tx_dom")},
    **{f"M{i}_enc": "tinyint" for i in range(1, 10)},
    **{c: "smallint" for c in ("card4", "card6", "ProductCD", "DeviceType")},
    **{
        c: "float"
        for c in (
            "amt_vs_card1_mean",
            "amt_vs_card1_zscore",
            "log_transaction_amt",
            "P_emaildomain_freq",
            "R_emaildomain_freq",
            "DeviceInfo_freq",
        )
    },
}


def with_time_features(df: DataFrame, time: str = "TransactionDT") -> DataFrame:
    t = F.col(time)
    return df.withColumns({"tx_hour": X.tx_hour(t), "tx_dow": X.tx_dow(t), "tx_dom": X.tx_dom(t)})


def with_amount_bucket(df: DataFrame, card: str = "card4", amount: str = "TransactionAmt") -> DataFrame:
    return df.withColumn("card4_amt_bucket", X.card_amount_bucket(F.col(card), F.col(amount)))


def with_log_amount(df: DataFrame, amount: str = "TransactionAmt") -> DataFrame:
    return df.withColumn("log_transaction_amt", F.log1p(amount))


def keyed_features(df: DataFrame, fit_on: DataFrame | None = None) -> DataFrame:
    """(TransactionID, every feature that looks at other rows).

    Only the few columns these features need are shuffled by card, pair, device and domain;
    the wide table is not involved until one final join on the id.
    """
    needed = [
        ROW_ID,
        "TransactionDT",
        "TransactionAmt",
        "card1",
        "addr1",
        "DeviceInfo",
        "P_emaildomain",
        "R_emaildomain",
    ]
    rows = df.select(*[c for c in needed if c in df.columns])
    learned = {"fit_on": fit_on if fit_on is not None else rows, "own_weights": fit_on is None}
    inputs = rows.columns
    result = with_amount_deviation(rows, **learned)
    if "addr1" in inputs:
        result = with_pair_count(result, **learned)
    for column, count_name in (
        ("DeviceInfo", "tx_count_device"),
        ("P_emaildomain", "tx_count_pdomain"),
        ("R_emaildomain", None),
    ):
        if column in inputs:
            result = with_entity_profile(
                result, column, count_name, f"{column}_freq", **learned
            )
    added = [ROW_ID, *[c for c in result.columns if c not in inputs]]
    return (
        result.select(*added)
        .join(trailing_counts(rows), ROW_ID, "left")
        .fillna(0, subset=list(DEFAULT_WINDOWS))
    )


def engineer_features(
    df: DataFrame,
    audit: DataFrame | None = None,
    medians: dict[str, float | None] | None = None,
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Merged transactions to model features.

    Statistics (means, counts, frequencies, codes, medians) come from ``df`` itself, or from
    ``fit_on`` to learn them on the training rows only. Medians and codes are fitted first, on
    the raw columns; the rest is one lazy plan. The features of other rows come back by the id, so
    a missing or repeated id is refused: it would lose or multiply rows.
    """
    require_row_ids(df, ROW_ID, "the feature input")
    kept = drop_sparse_columns(df, audit=audit)
    source = fit_on if fit_on is not None else kept
    featured = (
        kept.join(keyed_features(kept, fit_on), ROW_ID, "left")
        .transform(with_time_features)
        .transform(with_amount_bucket)
        .transform(with_log_amount)
        .transform(with_flag_codes)
        .transform(lambda d: with_label_codes(d, fit_on=source))
    )
    if medians is None:
        medians = exact_medians(source, median_targets(kept))
    return featured.transform(lambda d: impute(d, medians)).transform(drop_encoded_strings)


def stored(features: DataFrame) -> DataFrame:
    return narrow_types(features, STORED_TYPES)
