"""The SQL twin of each query, written independently of the operators."""

from __future__ import annotations

from catalogue.views import with_views

_HOUR = "CAST((TransactionDT // 3600) % 24 AS BIGINT)"
_DOW = "CAST((TransactionDT // 86400) % 7 AS BIGINT)"
_DOM = "CAST((TransactionDT // 86400) % 30 + 1 AS BIGINT)"
_TIER = """CASE WHEN fraud_prob < 0.30 THEN 'Low' WHEN fraud_prob > 0.70 THEN 'High'
                ELSE 'Medium' END"""
_TIER_SCORE = """CAST(CASE WHEN fraud_prob < 0.30 THEN 1 WHEN fraud_prob > 0.70 THEN 3
                           ELSE 2 END AS BIGINT)"""
_SEGMENTS = f"""
SELECT s.TransactionID, s.fraud_prob, {_TIER} AS risk_label, {_TIER_SCORE} AS risk_score,
       t.TransactionAmt, t.card4, i.DeviceType, {_HOUR} AS tx_hour
FROM scored s JOIN txn t USING (TransactionID) LEFT JOIN idn i USING (TransactionID)
"""
# The labels and bounds of amount ranges, here and below.
_AMOUNT_RANGE = """CASE WHEN {0} < 10 THEN '<$10' WHEN {0} < 50 THEN '$10-$50'
    WHEN {0} < 200 THEN '$50-$200' WHEN {0} < 1000 THEN '$200-$1000' ELSE '>$1000' END"""
_AMOUNT_BUCKET = """CASE WHEN TransactionAmt IS NULL OR TransactionAmt < 0 THEN 'nan'
    WHEN TransactionAmt < 10 THEN '<10' WHEN TransactionAmt < 50 THEN '10-50'
    WHEN TransactionAmt < 200 THEN '50-200' WHEN TransactionAmt < 1000 THEN '200-1000'
    ELSE '>1000' END"""
_VELOCITY = """
CASE WHEN {key} IS NULL THEN 0 ELSE
  count(*) OVER (PARTITION BY {key} ORDER BY {time}
                 RANGE BETWEEN {width} PRECEDING AND 1 PRECEDING)
  + row_number() OVER (PARTITION BY {key}, {time} ORDER BY {id}) - 1 END
"""


def _velocity(width: int, key="card1", time="TransactionDT", row_id="TransactionID") -> str:
    text = _VELOCITY.format(key=key, time=time, id=row_id, width=width)
    return f"CAST({text} AS BIGINT)"


def _group_count(*keys: str) -> str:
    missing = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"CASE WHEN {missing} THEN 0 ELSE count(*) OVER (PARTITION BY {', '.join(keys)}) END"


def _flag(column: str) -> str:
    return f"CAST(CASE {column} WHEN 'T' THEN 1 WHEN 'F' THEN 0 ELSE -1 END AS BIGINT)"


def _label(column: str) -> str:
    text = f"coalesce({column}, '__missing__')"
    return f"CAST(dense_rank() OVER (ORDER BY {text}) - 1 AS BIGINT)"


def _frequency(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL THEN 0.0::DOUBLE ELSE "
        f"count(*) OVER (PARTITION BY {column})::DOUBLE / count({column}) OVER () END"
    )


def _filled(column: str) -> str:
    return f"round(coalesce({column}, (SELECT median({column}) FROM merged)), 6) AS {column}"


_TXN_DOUBLES = ["TransactionAmt", "card2", "addr1", "dist1", "C1", "D1", "V1", "V2", "V3"]
_MERGED_COLUMNS = [
    "TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD", "card1",
    "card2", "card4", "card6", "addr1", "dist1", "P_emaildomain", "R_emaildomain", "C1", "D1",
    "M1", "M4", "V1", "V2", "V3", "id_01", "id_12", "DeviceType", "DeviceInfo",
]
_LINEITEM_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
_TYPES = {
    **{c: "bigint" for c in ("TransactionID", "isFraud", "TransactionDT", "card1")},
    **{c: "double" for c in [*_TXN_DOUBLES, "id_01"]},
}


def _audit(table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS col, count(*) - count({c}) AS null_count, count(*) AS total_rows, "
        f"round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 2) AS null_pct FROM {table}"
        for c in columns
    )


_ENGINEERED = f"""
SELECT TransactionID, isFraud, TransactionDT, TransactionAmt,
       {_label("ProductCD")} AS ProductCD, card1, {_filled("card2")}, {_label("card4")} AS card4,
       {_label("card6")} AS card6, {_filled("addr1")}, {_filled("dist1")},
       coalesce(C1, 0) AS C1, {_filled("D1")}, {_filled("V2")}, {_filled("V3")},
       {_filled("id_01")}, id_12, {_label("DeviceType")} AS DeviceType,
       round(TransactionAmt - CASE WHEN card1 IS NOT NULL THEN
           avg(TransactionAmt) OVER (PARTITION BY card1) END, 6) AS amt_vs_card1_mean,
       round((TransactionAmt - CASE WHEN card1 IS NOT NULL THEN
           avg(TransactionAmt) OVER (PARTITION BY card1) END)
         / (coalesce(stddev_samp(TransactionAmt) OVER (PARTITION BY card1), 1.0) + 1e-8), 6)
         AS amt_vs_card1_zscore,
       CAST({_group_count("card1", "addr1")} AS BIGINT) AS card1_addr1_count,
       CAST({_group_count("DeviceInfo")} AS BIGINT) AS tx_count_device,
       {_frequency("DeviceInfo")} AS DeviceInfo_freq,
       CAST({_group_count("P_emaildomain")} AS BIGINT) AS tx_count_pdomain,
       {_frequency("P_emaildomain")} AS P_emaildomain_freq,
       {_frequency("R_emaildomain")} AS R_emaildomain_freq,
       {_velocity(3600)} AS tx_count_card1_1h, {_velocity(86400)} AS tx_count_card1_24h,
       {_HOUR} AS tx_hour, {_DOW} AS tx_dow, {_DOM} AS tx_dom,
       coalesce(card4, 'unknown') || '_' || {_AMOUNT_BUCKET} AS card4_amt_bucket,
       round(ln(1 + TransactionAmt), 6) AS log_transaction_amt,
       {_flag("M1")} AS M1_enc, {_flag("M4")} AS M4_enc
FROM merged
"""
_MATRIX_COLUMNS = [
    "TransactionAmt", "tx_hour", "tx_count_card1_1h", "tx_count_card1_24h",
    "amt_vs_card1_mean", "card1_addr1_count", "ProductCD", "card4", "card6",
    "C1", "D1", "V2", "V3", "id_01",
]

_RANKED = """
SELECT TransactionID, isFraud,
       row_number() OVER (PARTITION BY isFraud
                          ORDER BY md5(CAST(TransactionID AS VARCHAR) || ':42')) AS rn,
       count(*) OVER (PARTITION BY isFraud) AS n
FROM txn
"""

_CURVE = """
groups AS (
  SELECT fraud_prob AS threshold, sum(isFraud)::BIGINT AS p, sum(1 - isFraud)::BIGINT AS n
  FROM scored GROUP BY fraud_prob),
curve AS (
  SELECT threshold, p, n, (sum(p) OVER w)::BIGINT AS tp, (sum(n) OVER w)::BIGINT AS fp,
         (sum(p) OVER ())::BIGINT AS all_p, (sum(n) OVER ())::BIGINT AS all_n
  FROM groups WINDOW w AS (ORDER BY threshold DESC)),
measured AS (
  SELECT *, tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / all_p AS recall,
         10 * (all_p - tp) + fp AS cost FROM curve),
f1 AS (
  SELECT *, 2 * precision * recall / (precision + recall + 1e-9) AS f1 FROM measured)
"""
_AUC = "sum((tp - p / 2.0::DOUBLE) * n) / (max(all_p)::DOUBLE * max(all_n))"
_AP = "sum(precision * p) / max(all_p)"
_CELLS = """
cells AS (
  SELECT count(*) FILTER (WHERE isFraud = 1 AND fraud_prob >= 0.5) AS tp,
         count(*) FILTER (WHERE isFraud = 0 AND fraud_prob >= 0.5) AS fp,
         count(*) FILTER (WHERE isFraud = 1 AND fraud_prob < 0.5) AS fn,
         count(*) FILTER (WHERE isFraud = 0 AND fraud_prob < 0.5) AS tn FROM scored)
"""
_REPORT = {
    "precision_fraud": "tp::DOUBLE / (tp + fp)",
    "recall_fraud": "tp::DOUBLE / (tp + fn)",
    "f1_fraud": "2.0::DOUBLE * tp / (2 * tp + fp + fn)",
    "precision_legit": "tn::DOUBLE / (tn + fn)",
    "recall_legit": "tn::DOUBLE / (tn + fp)",
    "f1_legit": "2.0::DOUBLE * tn / (2 * tn + fp + fn)",
}
_RATE = "100.0::DOUBLE * avg(isFraud)"


def _category(table: str, column: str, extra: str = "", tail: str = "") -> str:
    return (
        f"SELECT {column} AS category{extra}, count(*) AS transaction_count, "
        f"{_RATE} AS fraud_rate_pct FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} {tail}"
    )


def _correlation(column: str) -> str:
    return f"SELECT '{column}' AS feature, corr({column}, isFraud) AS correlation FROM txn"


_SUMMARY = """
count(*) AS transaction_count, round(sum({amount}), 6) AS total_amount,
round(avg({score}), 6) AS avg_fraud_prob, CAST(sum({label}) AS BIGINT) AS actual_fraud_count
"""

ORACLE = {
    "csv_roundtrip_scan": with_views("SELECT * FROM txn", "txn"),
    "pruned_scan": "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem",
    "limit_scan": with_views("SELECT * FROM scored ORDER BY TransactionID LIMIT 500", "scored"),
    "identity_csv_roundtrip": with_views("SELECT * FROM idn", "idn"),
    "eda_preview": with_views("SELECT * FROM merged ORDER BY TransactionID LIMIT 5", "merged"),
    "table_roundtrip": with_views("SELECT * FROM merged", "merged"),
    "model_checks": with_views(
        f"""SELECT isFraud, count(*) AS rows, 0 AS outside, 0 AS contradicted, 0 AS not_adding_up
        FROM ({_RANKED}) WHERE rn <= floor(n * 0.2::DOUBLE + 0.5) GROUP BY isFraud""",
        "txn",
    ),
    "search_checks": with_views(
        f"""SELECT isFraud, count(*) AS rows, CAST(3 AS BIGINT) AS trials, CAST(3 * 9 AS BIGINT) AS inside,
               CAST(1 AS BIGINT) AS ended, true AS best_is_best
        FROM ({_RANKED}) WHERE rn > floor(n * 0.2::DOUBLE + 0.5) GROUP BY isFraud""",
        "txn",
    ),
    # Two features: half of what a feature adds alone, and half of what it adds to the other.
    "attribution_known": with_views(
        """WITH v AS (SELECT -0.4 * 6 / 8 + (0.2 * 0.25 + 0.9 * 0.75) * 2 / 8 AS none,
               CASE WHEN TransactionAmt <= 100 THEN -0.4 ELSE 0.2 * 0.25 + 0.9 * 0.75 END AS amount,
               -0.4 * 6 / 8 + CASE WHEN D1 IS NULL OR D1 <= 10 THEN 0.2 ELSE 0.9 END * 2 / 8 AS days,
               CASE WHEN TransactionAmt <= 100 THEN -0.4 WHEN D1 IS NULL OR D1 <= 10 THEN 0.2 ELSE 0.9 END AS both_
               FROM txn)
        SELECT 'TransactionAmt' AS feature, round(avg(abs((amount - none) + (both_ - days)) / 2)::DOUBLE, 6) AS mean_abs_shap FROM v
        UNION ALL SELECT 'D1', round(avg(abs((days - none) + (both_ - amount)) / 2)::DOUBLE, 6) FROM v""",
        "txn",
    ),
    "smote_totals": with_views(
        """WITH n AS (SELECT count(*) FILTER (isFraud = 1) AS minority,
               CAST(floor(0.1 * count(*) FILTER (isFraud = 0)) AS BIGINT)
                 - count(*) FILTER (isFraud = 1) AS missing FROM txn)
        SELECT missing AS synthetic, minority AS bases, missing // minority AS fewest,
               (missing + minority - 1) // minority AS most, 5 * minority AS neighbor_pairs FROM n""",
        "txn",
    ),
    "smote_neighbors": with_views(
        """WITH m AS (SELECT TransactionID, TransactionAmt AS a, coalesce(D1, 0)::DOUBLE AS d, coalesce(C1, 0)::DOUBLE AS c
               FROM txn WHERE isFraud = 1),
        p AS (SELECT x.TransactionID, (x.a - y.a) * (x.a - y.a) + (x.d - y.d) * (x.d - y.d) + (x.c - y.c) * (x.c - y.c) AS distance
              FROM m x JOIN m y ON x.TransactionID <> y.TransactionID),
        r AS (SELECT *, row_number() OVER (PARTITION BY TransactionID ORDER BY distance) AS rank FROM p)
        SELECT TransactionID, rank, round(distance, 6) AS distance FROM r WHERE rank <= 5""",
        "txn",
    ),
    "rep_amount_counts": with_views(
        f"""SELECT amount_range, isFraud, count(*) AS transaction_count,
               CASE amount_range WHEN '<$10' THEN 1 WHEN '$10-$50' THEN 2 WHEN '$50-$200' THEN 3
               WHEN '$200-$1000' THEN 4 ELSE 5 END AS range_rank
        FROM (SELECT {_AMOUNT_RANGE.format('TransactionAmt')} AS amount_range, isFraud FROM txn)
        GROUP BY amount_range, isFraud""",
        "txn",
    ),
    "report_roundtrip": with_views(
        f"""SELECT amount_range, isFraud, count(*) AS transaction_count,
               CASE amount_range WHEN '<$10' THEN 1 WHEN '$10-$50' THEN 2 WHEN '$50-$200' THEN 3
               WHEN '$200-$1000' THEN 4 ELSE 5 END AS range_rank
        FROM (SELECT {_AMOUNT_RANGE.format('TransactionAmt')} AS amount_range, isFraud FROM txn)
        GROUP BY amount_range, isFraud""",
        "txn",
    ),
    "schema_listing": with_views(
        "SELECT CAST(position AS BIGINT) AS position, column_name, data_type, filled FROM ("
        + " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS column_name, '{_TYPES.get(c, 'string')}' AS data_type, "
            f"count({c}) AS filled FROM merged"
            for i, c in enumerate(_MERGED_COLUMNS)
        )
        + ")",
        "merged",
    ),
    "audit_csv_roundtrip": with_views(_audit("merged", _MERGED_COLUMNS), "merged"),
    "snapshot_roundtrip": with_views(
        "SELECT 'once' AS snapshot, TransactionID FROM txn UNION ALL SELECT 'latest', TransactionID FROM idn",
        "txn", "idn",
    ),
    "model_roundtrip": with_views(
        """WITH m AS (SELECT TransactionID, isFraud, CASE WHEN TransactionAmt <= 100 THEN -0.4
               WHEN D1 IS NULL OR D1 <= 10 THEN 0.2 ELSE 0.9 END::DOUBLE AS margin FROM txn)
        SELECT TransactionID, isFraud, round(1 / (1 + exp(-margin)), 6) AS fraud_prob,
               CAST(margin >= 0 AS BIGINT) AS predicted_label FROM m""",
        "txn",
    ),
    "merge_identity": with_views("SELECT * FROM merged", "merged"),
    "identity_coverage": with_views(
        "SELECT 100.0::DOUBLE * count(i.TransactionID) / count(t.TransactionID) "
        "AS identity_coverage_pct FROM txn t LEFT JOIN idn i USING (TransactionID)",
        "txn", "idn",
    ),
    "table_counts": with_views(
        "SELECT 'raw_transactions' AS tbl, count(*) AS rows FROM txn "
        "UNION ALL SELECT 'raw_identity', count(*) FROM idn "
        "UNION ALL SELECT 'merged_data', count(*) FROM merged "
        "UNION ALL SELECT 'engineered_features', count(*) FROM txn "
        "UNION ALL SELECT 'model_predictions', count(*) FROM scored "
        f"UNION ALL SELECT 'risk_segments', count(*) FROM ({_SEGMENTS})",
        "merged", "scored",
    ),
    "class_share": with_views(
        "SELECT isFraud, count(*) AS transaction_count, "
        "count(*) * 100.0::DOUBLE / sum(count(*)) OVER () AS pct_of_total "
        "FROM txn GROUP BY isFraud",
        "txn",
    ),
    "null_spot_check": with_views(
        "SELECT 'V1' AS col, 100.0::DOUBLE * sum(CASE WHEN V1 IS NULL THEN 1 ELSE 0 END) "
        "/ count(*) AS null_pct FROM txn",
        "txn",
    ),
    "null_rate_audit": with_views(_audit("merged", _MERGED_COLUMNS), "merged"),
    "null_rate_audit_lineitem": _audit("lineitem", _LINEITEM_COLUMNS),
    "sparse_column_ranking": with_views(
        f"SELECT *, null_pct > 80 AS dropped FROM ({_audit('merged', ['V1', 'V2', 'V3'])})",
        "merged",
    ),
    "drop_sparse_columns": with_views(
        "SELECT TransactionID, V2, V3 FROM txn", "txn"
    ),
    "fe_time": with_views(
        f"SELECT TransactionID, {_HOUR} AS tx_hour, {_DOW} AS tx_dow, {_DOM} AS tx_dom FROM txn",
        "txn",
    ),
    "fe_velocity": with_views(
        f"SELECT TransactionID, {_velocity(3600)} AS tx_count_card1_1h, "
        f"{_velocity(86400)} AS tx_count_card1_24h FROM txn",
        "txn",
    ),
    "fe_velocity_orders": with_views(
        "SELECT o_orderkey, "
        f"{_velocity(30 * 86400, 'o_custkey', 'o_seconds', 'o_orderkey')} AS orders_30d, "
        f"{_velocity(365 * 86400, 'o_custkey', 'o_seconds', 'o_orderkey')} AS orders_365d "
        "FROM ord",
        "ord",
    ),
    "fe_amount_deviation": with_views(
        "WITH stats AS (SELECT card1, avg(TransactionAmt) AS m, stddev_samp(TransactionAmt) AS s "
        "FROM txn GROUP BY card1) "
        "SELECT TransactionID, round(TransactionAmt - m, 6) AS amt_vs_card1_mean, "
        "round((TransactionAmt - m) / (coalesce(s, 1.0) + 1e-8), 6) AS amt_vs_card1_zscore "
        "FROM txn LEFT JOIN stats USING (card1)",
        "txn",
    ),
    "fe_entity_counts": with_views(
        f"SELECT TransactionID, CAST({_group_count('DeviceInfo')} AS BIGINT) AS tx_count_device, "
        f"CAST({_group_count('P_emaildomain')} AS BIGINT) AS tx_count_pdomain FROM merged",
        "merged",
    ),
    "fe_amount_bucket": with_views(
        f"SELECT TransactionID, coalesce(card4, 'unknown') || '_' || {_AMOUNT_BUCKET} "
        "AS card4_amt_bucket FROM txn",
        "txn",
    ),
    "fe_pair_count": with_views(
        f"SELECT TransactionID, CAST({_group_count('card1', 'addr1')} AS BIGINT) "
        "AS card1_addr1_count FROM txn",
        "txn",
    ),
    "fe_log_amount": with_views(
        "SELECT TransactionID, round(ln(1 + TransactionAmt), 6) AS log_transaction_amt FROM txn",
        "txn",
    ),
    "fe_flags": with_views(
        f"SELECT TransactionID, {_flag('M1')} AS M1_enc, {_flag('M4')} AS M4_enc FROM txn", "txn"
    ),
    "fe_label_encode": with_views(
        "SELECT TransactionID, "
        + ", ".join(f"{_label(c)} AS {c}" for c in ("card4", "card6", "ProductCD", "DeviceType"))
        + " FROM merged",
        "merged",
    ),
    "fe_frequency_encode": with_views(
        "SELECT TransactionID, "
        + ", ".join(
            f"{_frequency(c)} AS {c}_freq"
            for c in ("P_emaildomain", "R_emaildomain", "DeviceInfo")
        )
        + " FROM merged",
        "merged",
    ),
    "fe_impute": with_views(
        "SELECT TransactionID, coalesce(C1, 0) AS C1, "
        + ", ".join(
            _filled(c) for c in ("D1", "V1", "V2", "V3", "id_01", "card2", "addr1", "dist1")
        )
        + " FROM merged",
        "merged",
    ),
    "column_medians": " UNION ALL ".join(
        f"SELECT '{c}' AS col, round(median({c}), 6) AS median FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
    "fe_all": with_views(_ENGINEERED, "merged"),
    "feature_matrix": with_views(
        "SELECT TransactionID, isFraud, "
        + ", ".join(f"coalesce(CAST({c} AS DOUBLE), -999.0) AS {c}" for c in _MATRIX_COLUMNS)
        + f" FROM ({_ENGINEERED})",
        "merged",
    ),
    "split_stratified": with_views(
        f"SELECT TransactionID, isFraud, rn <= floor(n * 0.2::DOUBLE + 0.5) AS is_test "
        f"FROM ({_RANKED})",
        "txn",
    ),
    "kfold_stratified": with_views(
        "SELECT TransactionID, isFraud, CAST(CASE WHEN rn <= n // 3 THEN 0 "
        f"WHEN rn <= 2 * n // 3 THEN 1 ELSE 2 END AS BIGINT) AS fold FROM ({_RANKED})",
        "txn",
    ),
    "class_weight": with_views(
        "SELECT TransactionID, isFraud, CASE WHEN isFraud = 1 "
        "THEN (1 - 0.035::DOUBLE) / 0.035::DOUBLE ELSE 1.0 END AS class_weight FROM txn",
        "txn",
    ),
    "seeded_sample": with_views(
        "SELECT TransactionID, isFraud FROM txn "
        "ORDER BY md5(CAST(TransactionID AS VARCHAR) || ':42') LIMIT 5000",
        "txn",
    ),
    "eval_auc": with_views(
        f"WITH {_CURVE} SELECT {_AUC} AS auc_roc FROM curve", "scored"
    ),
    "eval_average_precision": with_views(
        f"WITH {_CURVE} SELECT round({_AP}, 6) AS avg_precision FROM measured", "scored"
    ),
    "eval_report": with_views(
        f"WITH {_CELLS} SELECT "
        + ", ".join(f"{e} AS {n}" for n, e in _REPORT.items())
        + ", tp + fn AS support_fraud, tn + fp AS support_legit FROM cells",
        "scored",
    ),
    "eval_confusion": with_views(
        "SELECT isFraud AS actual, count(*) FILTER (WHERE fraud_prob < 0.5) AS predicted_0, "
        "count(*) FILTER (WHERE fraud_prob >= 0.5) AS predicted_1 FROM scored GROUP BY isFraud",
        "scored",
    ),
    "eval_calibration": with_views(
        """SELECT CASE WHEN fraud_prob < 0.10 THEN '0.00-0.10' WHEN fraud_prob < 0.20 THEN '0.10-0.20'
                  WHEN fraud_prob < 0.30 THEN '0.20-0.30' WHEN fraud_prob < 0.50 THEN '0.30-0.50'
                  WHEN fraud_prob < 0.70 THEN '0.50-0.70' ELSE '0.70+' END AS prob_bucket,
                  count(*) AS count, CAST(sum(isFraud) AS BIGINT) AS actual_fraud,
                  100.0::DOUBLE * sum(isFraud) / count(*) AS actual_fraud_rate_pct
           FROM scored GROUP BY prob_bucket""",
        "scored",
    ),
    "quality_gate": with_views(
        f"""WITH {_CURVE}
        SELECT auc AS auc_roc,
               CASE WHEN auc < 0.80 THEN 'below_0.80' WHEN auc < 0.85 THEN 'below_0.85'
               WHEN auc < 0.88 THEN 'below_0.88' END AS band
        FROM (SELECT {_AUC} AS auc FROM curve)""",
        "scored",
    ),
    "pr_curve": with_views(
        f"WITH {_CURVE} SELECT threshold, tp, fp, precision, recall FROM measured",
        "scored",
    ),
    "f1_threshold": with_views(
        f"WITH {_CURVE} SELECT threshold AS f1_optimal_threshold, f1 "
        "FROM f1 ORDER BY f1.f1 DESC, threshold LIMIT 1",
        "scored",
    ),
    "cost_threshold": with_views(
        f"WITH {_CURVE} SELECT threshold AS cost_optimal_threshold, cost "
        "FROM measured ORDER BY cost, threshold LIMIT 1",
        "scored",
    ),
    "threshold_analysis": with_views(
        f"""WITH {_CURVE}
        SELECT (SELECT threshold FROM f1 ORDER BY f1.f1 DESC, threshold LIMIT 1)
                 AS f1_optimal_threshold,
               (SELECT threshold FROM measured ORDER BY cost, threshold LIMIT 1)
                 AS cost_optimal_threshold,
               0.3::DOUBLE AS business_low, 0.7::DOUBLE AS business_high""",
        "scored",
    ),
    "risk_tiers": with_views(
        f"SELECT TransactionID, {_TIER} AS risk_label, {_TIER_SCORE} AS risk_score FROM scored",
        "scored",
    ),
    "tier_counts": with_views(
        f"SELECT {_TIER} AS risk_label, count(*) AS transaction_count, "
        "100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS pct_of_total "
        "FROM scored GROUP BY risk_label",
        "scored",
    ),
    "risk_segments": with_views(
        _SEGMENTS,
        "txn", "idn", "scored",
    ),
    "rep_card_type": with_views(
        f"WITH segs AS ({_SEGMENTS}) "
        "SELECT coalesce(t.card4, 'unknown') AS card_type, g.risk_label, "
        + _SUMMARY.format(amount="t.TransactionAmt", score="s.fraud_prob", label="t.isFraud")
        + "FROM scored s JOIN segs g USING (TransactionID) JOIN txn t USING (TransactionID) "
        "GROUP BY t.card4, g.risk_label",
        "txn", "idn", "scored",
    ),
    "rep_device": with_views(
        f"WITH segs AS ({_SEGMENTS}) "
        "SELECT coalesce(g.DeviceType, 'unknown') AS device_type, g.risk_label, "
        + _SUMMARY.format(amount="g.TransactionAmt", score="g.fraud_prob", label="s.isFraud")
        + "FROM segs g JOIN scored s USING (TransactionID) GROUP BY g.DeviceType, g.risk_label",
        "txn", "idn", "scored",
    ),
    "rep_fraud_rate_over_time": with_views(
        f"""WITH timed AS (SELECT *, {_HOUR} AS tx_hour, {_DOW} AS tx_dow FROM txn)
        SELECT tx_dow AS day_of_week, tx_hour AS hour_of_day, count(*) AS transaction_count,
               CAST(sum(isFraud) AS BIGINT) AS fraud_count,
               100.0::DOUBLE * sum(isFraud) / count(*) AS fraud_rate_pct,
               round(avg(TransactionAmt), 6) AS avg_amount,
               CASE tx_dow WHEN 0 THEN 'Mon' WHEN 1 THEN 'Tue' WHEN 2 THEN 'Wed' WHEN 3 THEN 'Thu'
                 WHEN 4 THEN 'Fri' WHEN 5 THEN 'Sat' ELSE 'Sun' END AS day_name
        FROM timed GROUP BY tx_dow, tx_hour""",
        "txn",
    ),
    "rep_tier_summary": with_views(
        f"""SELECT risk_label, risk_score, count(*) AS transaction_count,
               100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS pct_of_total,
               round(avg(TransactionAmt), 6) AS avg_amount,
               round(avg(fraud_prob), 6) AS avg_fraud_prob
        FROM ({_SEGMENTS}) GROUP BY risk_label, risk_score""",
        "txn", "idn", "scored",
    ),
    "rep_amount_distribution": with_views(
        f"SELECT {_AMOUNT_RANGE.format('TransactionAmt')} AS amount_range, isFraud, "
        "count(*) AS transaction_count, round(avg(TransactionAmt), 6) AS avg_amount "
        "FROM txn GROUP BY amount_range, isFraud",
        "txn",
    ),
    "rep_amount_distribution_lineitem": (
        f"SELECT {_AMOUNT_RANGE.format('l_quantity')} AS amount_range, l_returnflag, "
        "count(*) AS transaction_count, avg(l_quantity) AS avg_amount "
        "FROM lineitem GROUP BY amount_range, l_returnflag"
    ),
    "rep_metrics_long": with_views(
        f"WITH {_CURVE}, {_CELLS} "
        f"SELECT 'auc_roc' AS metric_name, round({_AUC}, 6) AS value FROM curve "
        f"UNION ALL SELECT 'avg_precision', round({_AP}, 6) FROM measured "
        + " ".join(f"UNION ALL SELECT '{n}', round({e}, 6) FROM cells" for n, e in _REPORT.items())
        + " UNION ALL SELECT 'support_fraud', (tp + fn)::DOUBLE FROM cells"
        " UNION ALL SELECT 'support_legit', (tn + fp)::DOUBLE FROM cells",
        "scored",
    ),
    "eda_shape": with_views(
        f"SELECT count(*) AS rows, CAST({len(_MERGED_COLUMNS)} AS BIGINT) AS columns FROM merged",
        "merged",
    ),
    "eda_class_balance": with_views(
        """SELECT isFraud, count(*) AS transaction_count,
               (SELECT 100.0::DOUBLE * avg(isFraud) FROM txn) AS fraud_rate_pct,
               (SELECT CAST(floor(1 / avg(isFraud)) AS BIGINT) FROM txn) AS imbalance_ratio
        FROM txn GROUP BY isFraud""",
        "txn",
    ),
    "eda_amount_histogram": with_views(
        """WITH x AS (SELECT isFraud, ln(1 + TransactionAmt) AS x FROM txn),
        r AS (SELECT isFraud, min(x) AS lo, max(x) AS hi, count(*) AS total FROM x GROUP BY isFraud),
        b AS (SELECT isFraud, lo, hi, total,
                     CAST(least(floor((x - lo) * 60 / (hi - lo)), 59) AS BIGINT) AS bin
              FROM x JOIN r USING (isFraud)),
        g AS (SELECT isFraud, lo, hi, total, u.bin FROM r, unnest(range(0, 60)) AS u(bin)),
        c AS (SELECT isFraud, bin, count(*) AS n FROM b GROUP BY isFraud, bin)
        SELECT g.isFraud, g.bin, round(lo + g.bin * ((hi - lo) / 60), 6) AS bin_start,
               coalesce(n, 0) AS transaction_count,
               round(coalesce(n, 0) / (total * ((hi - lo) / 60)), 6) AS density
        FROM g LEFT JOIN c ON g.isFraud = c.isFraud AND g.bin = c.bin""",
        "txn",
    ),
    "eda_rate_by_bucket": with_views(
        f"SELECT {_AMOUNT_RANGE.format('TransactionAmt')} AS amt_bucket, "
        f"{_RATE} AS fraud_rate_pct FROM txn WHERE TransactionAmt >= 0 GROUP BY amt_bucket",
        "txn",
    ),
    "eda_hour_matrix": with_views(
        f"WITH timed AS (SELECT isFraud, {_HOUR} AS h, {_DOW} AS tx_dow FROM txn) SELECT tx_dow, "
        + ", ".join(f"{_RATE} FILTER (WHERE h = {h}) AS h{h}" for h in range(24))
        + " FROM timed GROUP BY tx_dow",
        "txn",
    ),
    "eda_hourly": with_views(
        f"SELECT {_HOUR} AS tx_hour, {_RATE} AS fraud_rate_pct, "
        f"count(*) AS transaction_count FROM txn GROUP BY {_HOUR}",
        "txn",
    ),
    "eda_rate_by_category": with_views(
        _category("txn", "P_emaildomain", tail=f"ORDER BY {_RATE} DESC, P_emaildomain LIMIT 15"),
        "txn",
    ),
    "eda_rate_by_card": with_views(
        _category("txn", "card4", ", 'card4' AS column_name")
        + " UNION ALL "
        + _category("txn", "card6", ", 'card6' AS column_name"),
        "txn",
    ),
    "eda_correlation": with_views(
        "WITH c AS (" + " UNION ALL ".join(
            _correlation(c)
            for c in ("TransactionAmt", "card1", "card2", "addr1", "dist1", "C1", "D1", "V1", "V2", "V3")
        )
        + "), a AS (SELECT * FROM c ORDER BY correlation DESC, feature LIMIT 10), "
        "b AS (SELECT * FROM c ORDER BY correlation, feature LIMIT 10) "
        "SELECT feature, round(correlation, 6) AS correlation "
        "FROM (SELECT * FROM a UNION ALL SELECT * FROM b)",
        "txn",
    ),
    "eda_identity_split": with_views(
        f"SELECT DeviceType IS NOT NULL AS has_identity, count(*) AS transaction_count, "
        f"{_RATE} AS fraud_rate_pct, "
        "100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS pct_of_total "
        "FROM merged GROUP BY has_identity",
        "merged",
    ),
    "eda_device_type": with_views(_category("merged", "DeviceType"), "merged"),
    "eda_device_info_top15": with_views(
        _category(
            "merged",
            "DeviceInfo",
            tail=f"HAVING count(*) >= 50 ORDER BY {_RATE} DESC, DeviceInfo LIMIT 15",
        ),
        "merged",
    ),
}

# The parameters that metrics_files writes.
_PARAMS = {
    "n_estimators": 10, "max_depth": 4, "learning_rate": 0.2, "subsample": 0.9, "colsample_bytree": 0.9,
    "min_child_weight": 2, "gamma": 0,
}
ORACLE["threshold_file"] = ORACLE["threshold_analysis"]
ORACLE["metrics_files"] = (
    f"WITH long AS ({ORACLE['rep_metrics_long']}) SELECT 'json' AS file, * FROM long UNION ALL SELECT 'csv', * FROM long "
    + " ".join(f"UNION ALL SELECT 'params', '{n}', {v}::DOUBLE" for n, v in _PARAMS.items())
)
# Rows of the job's outputs; without training there are no attributions.
_JOB = {
    "merged_data.parquet": "csv_roundtrip_scan",
    "engineered_features.parquet": "csv_roundtrip_scan",
    "v_null_rates": "null_rate_audit",
    "threshold_analysis": "threshold_analysis",
    "fraud_summary_by_card_type": "rep_card_type",
    "fraud_summary_by_device": "rep_device",
    "fraud_rate_over_time": "rep_fraud_rate_over_time",
    "risk_segments_summary": "rep_tier_summary",
    "transaction_amount_distribution": "rep_amount_distribution",
    "model_performance_metrics": "rep_metrics_long",
    "observed": "csv_roundtrip_scan",
}
ORACLE["job_outputs"] = (
    f"SELECT * FROM ({ORACLE['table_counts']}) "
    + " ".join(f"UNION ALL SELECT '{n}', count(*) FROM ({ORACLE[q]})" for n, q in _JOB.items())
    + " UNION ALL SELECT 'feature_importance_shap', 0"
)
