"""Transaction-shaped views over the given tables; one SQL text serves both engines.

The columns mirror the card-transaction schema. ``events`` has one row per transaction; the
missing values the operators deal with are derived from the payload number ``k``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_SPARK_SECONDS = "timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)"
_DUCKDB_SECONDS = "date_diff('second', TIMESTAMP '2024-01-01 00:00:00', ts)"
_SPARK_ORDER_SECONDS = "timestampdiff(SECOND, TIMESTAMP_NTZ'1990-01-01 00:00:00', o_orderdate)"
_DUCKDB_ORDER_SECONDS = "date_diff('second', TIMESTAMP '1990-01-01 00:00:00', o_orderdate)"

_PAYLOAD = """
    SELECT event_id, user_id, event_type, value, {seconds} AS dt,
           CAST(regexp_extract(props, '[0-9]+', 0) AS BIGINT) AS k
    FROM {events}
"""
_FRAUD = """CAST(CASE WHEN (event_type = 'error' AND k < 14) OR k = 97 THEN 1 ELSE 0 END
                 AS BIGINT)"""

_TXN = f"""
SELECT event_id AS TransactionID,
       {_FRAUD} AS isFraud,
       CAST(dt AS BIGINT) AS TransactionDT,
       value * CAST('5.123456789' AS DOUBLE) AS TransactionAmt,
       event_type AS ProductCD,
       CASE WHEN k = 31 THEN NULL ELSE user_id END AS card1,
       CASE WHEN k = 5 THEN NULL ELSE CAST(100 + k AS DOUBLE) END AS card2,
       CASE user_id % 6 WHEN 0 THEN NULL WHEN 1 THEN 'visa' WHEN 2 THEN 'mastercard'
            WHEN 3 THEN 'discover' WHEN 4 THEN 'american express' ELSE 'visa' END AS card4,
       CASE WHEN user_id % 4 = 0 THEN 'debit' WHEN user_id % 4 = 1 THEN 'charge card'
            ELSE 'credit' END AS card6,
       CASE WHEN k % 9 = 0 THEN NULL ELSE CAST(k % 10 AS DOUBLE) END AS addr1,
       CASE WHEN k > 40 THEN NULL ELSE value END AS dist1,
       CASE WHEN k % 7 = 0 THEN NULL ELSE concat('dom', CAST(k % 12 AS STRING), '.com')
            END AS P_emaildomain,
       CASE WHEN event_type IN ('purchase', 'error')
            THEN concat('mail', CAST(user_id % 5 AS STRING), '.net') END AS R_emaildomain,
       CASE WHEN k = 60 THEN NULL ELSE CAST(k % 5 AS DOUBLE) END AS C1,
       CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(k AS DOUBLE) END AS D1,
       CASE user_id % 3 WHEN 0 THEN 'T' WHEN 1 THEN 'F' ELSE NULL END AS M1,
       CASE k % 4 WHEN 0 THEN 'M0' WHEN 1 THEN 'M2' WHEN 2 THEN 'T' ELSE NULL END AS M4,
       CASE WHEN k < 10 THEN value ELSE NULL END AS V1,
       CASE WHEN k < 50 THEN value ELSE NULL END AS V2,
       CASE WHEN k < 75 THEN value * value ELSE NULL END AS V3
FROM ({_PAYLOAD}) AS payload
"""

_IDN = f"""
SELECT event_id AS TransactionID,
       CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(k - 50 AS DOUBLE) END AS id_01,
       CASE WHEN value < 20 THEN 'NotFound' ELSE 'Found' END AS id_12,
       CASE WHEN k % 10 = 9 THEN NULL WHEN k % 3 = 0 THEN 'mobile' ELSE 'desktop'
            END AS DeviceType,
       CASE WHEN k % 12 = 0 THEN NULL ELSE concat('dev-', CAST(user_id % 25 AS STRING))
            END AS DeviceInfo
FROM ({_PAYLOAD}) AS payload
WHERE event_type IN ('error', 'signup')
"""

_SCORED = f"""
SELECT event_id AS TransactionID, {_FRAUD} AS isFraud,
       CAST(0.55 AS DOUBLE)
         * (CAST((event_id * 7919 + user_id * 104729) % 10000 AS DOUBLE) / CAST(10000 AS DOUBLE))
         + CAST(0.45 AS DOUBLE) * {_FRAUD} AS fraud_prob
FROM ({_PAYLOAD}) AS payload
"""

_ORDERS = """
SELECT o_orderkey, o_custkey, CAST({seconds} AS BIGINT) AS o_seconds, o_totalprice,
       o_orderstatus, o_orderpriority
FROM {orders}
"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _events_view(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    query = text.replace("{seconds}", _SPARK_SECONDS)
    return spark.sql(query, events=_table(spark, sf_dir, "events"))


def txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_view(spark, sf_dir, _TXN)


def idn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_view(spark, sf_dir, _IDN)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events_view(spark, sf_dir, _SCORED)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    query = _ORDERS.replace("{seconds}", _SPARK_ORDER_SECONDS)
    return spark.sql(query, orders=_table(spark, sf_dir, "orders"))


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "lineitem")


def _duckdb_events(text: str) -> str:
    return text.replace("{seconds}", _DUCKDB_SECONDS).replace("{events}", "events")


# The same views for the SQL twins, as common table expressions.
CTES = {
    "txn": _duckdb_events(_TXN),
    "idn": _duckdb_events(_IDN),
    "scored": _duckdb_events(_SCORED),
    "ord": _ORDERS.replace("{seconds}", _DUCKDB_ORDER_SECONDS).replace("{orders}", "orders"),
    "merged": "SELECT * FROM txn LEFT JOIN idn USING (TransactionID)",
}
_NEEDS = {"merged": ["txn", "idn"]}


def with_views(query: str, *names: str) -> str:
    """``query`` preceded by the views it reads."""
    ordered: list[str] = []
    for name in names:
        for needed in [*_NEEDS.get(name, []), name]:
            if needed not in ordered:
                ordered.append(needed)
    views = ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered)
    body = query.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {views},\n{body[5:]}"
    return f"WITH {views}\n{body}"
