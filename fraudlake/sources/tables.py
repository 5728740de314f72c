"""Persisted tables and report files (SNK-01..11)."""

from __future__ import annotations

import json
import uuid
from zlib import crc32

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fraudlake.session import list_names, release, rename, write_text

BUCKET_BYTES = 1 << 30


def buckets_for(spark: SparkSession, *paths: str) -> int:
    """Buckets for tables made from these files: about 1 GB of input each, and no fewer than the
    shuffle partitions, so that joins with other rows need no exchange of the tables."""
    sizes = spark.read.format("binaryFile").load(list(paths)).agg(F.sum("length")).first()[0] or 0
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-sizes // BUCKET_BYTES))


class TableStore:
    """Parquet tables below one folder, bucketed by the transaction id.

    All tables of the pipeline are joined on that id. Each table is written once in buckets of
    the id, sorted inside, so later joins between the tables read matching buckets and need no
    shuffle of the wide rows. The folder is the only state: a new session declares the tables
    again from it.

    A write goes to a folder of its own. When it has ended, a manifest with the next number, renamed
    into its place, names that folder, the bucket column and the number of buckets. The manifest with
    the highest number is the table, so a write that is cut short changes nothing, and readers see
    the old table or the new one. The table before the current one is kept for readers that have begun; those
    before it are deleted. What a killed write left is never read.
    """

    def __init__(
        self, spark: SparkSession, folder: str, buckets: int | None = None, key: str = "TransactionID"
    ):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.key = key
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.manifests = f"{self.folder}/_manifests"
        # One name per folder, so stores of one session do not meet in the catalog.
        self.prefix = "fl_" + format(crc32(self.folder.encode()), "08x") + "_"

    def replace(self, name: str, df: DataFrame) -> int:
        """Write the table, in place of an older one, and return its row count.

        ``df`` may read the older one. The count is observed during the write; there is no second scan.
        """
        observation = Observation(f"rows_{name}")
        version = uuid.uuid4().hex
        path = f"{self.folder}/{name}/{version}"
        (
            df.observe(observation, F.count(F.lit(1)).alias("rows"))
            .repartition(self.buckets, self.key)
            .write.mode("errorifexists")
            .format("parquet")
            .option("path", path)
            .bucketBy(self.buckets, self.key)
            .sortBy(self.key)
            .saveAsTable(self._declared(name, version))
        )
        files = len(list_names(self.spark, path))
        self._publish(name, {"version": version, "key": self.key, "buckets": self.buckets, "files": files})
        return observation.get["rows"]

    def _declared(self, name: str, version: str) -> str:
        return f"{self.prefix}{name}_{version}"

    def _numbers(self, name: str) -> list[int]:
        """Numbers of the table's manifests, ascending."""
        return sorted(int(n.split(".")[0]) for n in list_names(self.spark, f"{self.manifests}/{name}") if n.endswith(".json"))

    def _manifest(self, name: str, number: int) -> dict:
        return json.loads(self.spark.read.text(f"{self.manifests}/{name}/{number}.json").first()[0])

    def _publish(self, name: str, manifest: dict) -> None:
        numbers = self._numbers(name)
        number = numbers[-1] + 1 if numbers else 1
        held = f"{self.manifests}/{name}/held-{manifest['version']}"
        write_text(self.spark, held, json.dumps(manifest))
        rename(self.spark, held, f"{self.manifests}/{name}/{number}.json")
        for old in numbers[:-1]:
            gone = self._manifest(name, old)["version"]
            self.spark.sql(f"DROP TABLE IF EXISTS {self._declared(name, gone)}")
            release(self.spark, [f"{self.manifests}/{name}/{old}.json", f"{self.folder}/{name}/{gone}"])

    def current(self, name: str) -> dict | None:
        """The manifest of the table, None if no write of it has ended."""
        numbers = self._numbers(name)
        return self._manifest(name, numbers[-1]) if numbers else None

    def path(self, name: str) -> str:
        manifest = self.current(name)
        if manifest is None:
            raise FileNotFoundError(f"{self.folder}: no write of table {name} has ended")
        return f"{self.folder}/{name}/{manifest['version']}"

    def layout(self, name: str) -> tuple[str, int] | None:
        """The bucket column and the number of buckets that a table has."""
        manifest = self.current(name)
        return (manifest["key"], manifest["buckets"]) if manifest else None

    def read(self, name: str) -> DataFrame:
        """The table as its last write that ended left it; FileNotFoundError without one.

        Its folder must have the mark and the files that it had when the write ended.
        """
        path = self.path(name)
        manifest = self.current(name)
        files = list_names(self.spark, path)
        if "_SUCCESS" not in files or len(files) < manifest["files"]:
            raise FileNotFoundError(f"{path} is incomplete")
        table = self._declared(name, manifest["version"])
        if not self.spark.catalog.tableExists(table):
            schema = self.spark.read.parquet(path).schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
            self.spark.sql(
                f"CREATE TABLE {table} ({columns}) USING parquet "
                f"CLUSTERED BY (`{manifest['key']}`) SORTED BY (`{manifest['key']}`) "
                f"INTO {manifest['buckets']} BUCKETS LOCATION '{path}'"
            )
        return self.spark.table(table)


def snapshot_once(df: DataFrame, path: str) -> None:
    """Write parquet only if nothing is there yet."""
    df.write.mode("ignore").parquet(path)


def snapshot(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def _one_file(spark: SparkSession, folder: str, path: str) -> None:
    """Moves the only part file of ``folder`` to ``path``, in place of an older file there."""
    parts = [n for n in list_names(spark, folder) if n.startswith("part-")]
    if len(parts) != 1:
        raise ValueError(f"{folder} has {len(parts)} part files")
    release(spark, [path])
    rename(spark, f"{folder}/{parts[0]}", path)
    release(spark, [folder])


def write_report(df: DataFrame, path: str) -> None:
    """One CSV file with header; reports are aggregates of at most a few hundred rows."""
    folder = f"{path}-{uuid.uuid4().hex}"
    df.coalesce(1).write.option("emptyValue", "").csv(folder, header=True)
    _one_file(df.sparkSession, folder, path)


def write_metrics_json(metrics: DataFrame, params: dict[str, float], path: str) -> None:
    """One file with one JSON object: the metrics, the confusion matrix and the parameters used."""
    entries = [F.lit(x) for k, v in params.items() for x in (k, float(v))]
    mapped = F.create_map(*entries) if entries else F.create_map().cast("map<string,double>")
    folder = f"{path}-{uuid.uuid4().hex}"
    metrics.withColumn("best_params", mapped).coalesce(1).write.json(folder)
    _one_file(metrics.sparkSession, folder, path)
