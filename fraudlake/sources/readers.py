"""Readers (SRC-01..08)."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fraudlake.operators.audit import nan_to_null

TRANSACTIONS_FILE = "train_transaction.csv"
IDENTITY_FILE = "train_identity.csv"

# The columns profiled in the exploratory reports.
KEY_COLUMNS = (
    ["TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD"]
    + [f"card{i}" for i in range(1, 7)]
    + ["addr1", "addr2", "dist1", "dist2", "P_emaildomain", "R_emaildomain"]
    + [f"C{i}" for i in range(1, 15)]
    + [f"D{i}" for i in (1, 2, 3, 4, 5, 10, 11, 15)]
    + [f"M{i}" for i in range(1, 10)]
    + ["DeviceType", "DeviceInfo"]
    + [f"id_{i:02d}" for i in (1, 2, 12, 15, 30, 31)]
)
# Identity columns that hold numbers.
NUMERIC_IDENTITY = [f"id_{i:02d}" for i in (*range(1, 12), 13, 14, *range(17, 23), 24, 25, 26, 32)]

_TYPE_RULES = [
    (r"TransactionID|isFraud|TransactionDT|card1", T.LongType()),
    (r"TransactionAmt|card[235]|addr[12]|dist[12]|[CDV]\d+", T.DoubleType()),
    (r"ProductCD|card[46]|[PR]_emaildomain|M\d|DeviceType|DeviceInfo", T.StringType()),
    ("|".join(NUMERIC_IDENTITY), T.DoubleType()),
    (r"id_\d\d", T.StringType()),
]


def schema_for(names: Sequence[str]) -> T.StructType | None:
    """The declared schema of known columns, or None if a name is not known."""
    fields = []
    for name in names:
        found = [kind for pattern, kind in _TYPE_RULES if re.fullmatch(pattern, name)]
        if not found:
            return None
        fields.append(T.StructField(name, found[0]))
    return T.StructType(fields)


def read_csv_table(spark: SparkSession, path: str, sampling_ratio: float = 0.01) -> DataFrame:
    """A CSV with header. Known columns are read with declared types, in one pass over the
    file; a file with other columns gets its types from a sample of its rows."""
    reader = spark.read.option("header", True).option("nanValue", "NaN")
    header = reader.csv(path).columns
    schema = schema_for(header)
    if schema is not None:
        return nan_to_null(reader.schema(schema).csv(path))
    inferred = reader.option("inferSchema", True).option("samplingRatio", sampling_ratio)
    return nan_to_null(inferred.csv(path))


def read_transactions_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_table(spark, path)


def read_identity_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv_table(spark, path)


def read_inputs(spark: SparkSession, data_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both inputs; a missing folder or file raises ``AnalysisException`` before any job runs."""
    base = data_dir.rstrip("/")
    return (
        read_transactions_csv(spark, f"{base}/{TRANSACTIONS_FILE}"),
        read_identity_csv(spark, f"{base}/{IDENTITY_FILE}"),
    )


def read_key_columns(
    spark: SparkSession, path: str, columns: Sequence[str] = tuple(KEY_COLUMNS)
) -> DataFrame:
    """Only the wanted columns that the table has; the others are never read from the files."""
    df = spark.read.parquet(path)
    return df.select(*[c for c in columns if c in df.columns])


def read_limited(df: DataFrame, rows: int = 200_000, row_id: str = "TransactionID") -> DataFrame:
    """The ``rows`` first rows by id: which ones they are does not depend on the plan."""
    return df.orderBy(row_id).limit(rows)


def list_columns(df: DataFrame) -> DataFrame:
    """(position, column_name, data_type, filled) of a table; ``filled`` counts values that are not null.

    All columns are counted in one scan.
    """
    lines = [
        F.struct(
            F.lit(i).cast("long").alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.count(F.col(f"`{f.name}`")).alias("filled"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return df.agg(F.array(*lines).alias("lines")).select(F.inline("lines"))


def read_audit_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(
        path, header=True, schema="col string, null_count long, total_rows long, null_pct double"
    )


def with_identity(
    transactions: DataFrame, identity: DataFrame, row_id: str = "TransactionID"
) -> DataFrame:
    """Every transaction with its identity columns, if it has any (JN-01)."""
    return transactions.join(identity, row_id, "left")


def count_rows(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("tbl"), "rows")
