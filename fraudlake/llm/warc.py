"""Web archives with a two-level capture index.

Pages are written as WARC records, each a gzip member, and found again through an index: lines
sorted by reversed-host URL key lie in compressed blocks, a sparse directory has the first key of
each block, and a look-up searches part, block and line by bisection before it reads the range of
the one record. Files go to the shared folder that ``spark.checkpoint.dir`` names, by any file
system that pyarrow opens. A task attempt writes files of its own name; the index has only those of
attempts whose result Spark took, so a lost executor leaves nothing but unused files.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.llm.common import stash, table
from fraudlake.llm.warc_files import IndexReader, IndexWriter, index_key, make_record, open_folder, read_record
from fraudlake.session import scratch_folder

LEAST_REVISIT = 1000  # bytes
LANES = 16
ROLL = 1 << 30  # bytes of an archive file
TASK_BYTES = 64 << 20  # of an archive, read by a task
CAPTURES = "surt string, page_id long, file string, offset long, length long"
RECORDS = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
)


def url_key(url: str) -> Column:
    """``com,example,www)/path?query``: the host's labels reversed; null: empty; no host: as it is."""
    whole = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#]*?)(?::(?:80|443)?)?(/[^#]*|\?[^#]*|)(?:#.*)?$"
    host = F.lower(F.regexp_extract(url, whole, 1))
    rest = F.regexp_extract(url, whole, 2)
    key = F.concat(
        F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(rest == "", "/").otherwise(rest)
    )
    return F.coalesce(F.when(host != "", key).otherwise(F.col(url)), F.lit(""))


def with_revisits(pages: DataFrame) -> DataFrame:
    """Adds ``refers_to`` to ``(page_id, payload)`` rows: the largest page_id with the same payload.

    Null for the row that has that id, for payloads under LEAST_REVISIT bytes, and where no row has
    an id; rows that repeat the largest id are all responses. The largest ids are aggregated before
    the shuffle; payloads meet them dealt to LANES lanes, so a payload of a third of all rows is
    split, and small payloads are spread by their id.
    """
    large = pages.where(F.octet_length("payload") >= LEAST_REVISIT)
    shared = (
        large.groupBy(F.sha1("payload").alias("_digest"))
        .agg(F.max("page_id").alias("_last"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1 and _last is not null")
        .select("_digest", "_last", F.explode(F.sequence(F.lit(0), F.lit(LANES - 1))).alias("_lane"))
    )
    key = F.when(F.octet_length("payload") >= LEAST_REVISIT, F.sha1("payload")).otherwise(
        F.coalesce(F.col("page_id"), F.xxhash64("url")).cast("string")
    )
    lane = F.pmod(F.xxhash64("page_id", "url"), F.lit(LANES)).cast("int")
    return (
        pages.withColumns({"_digest": key, "_lane": lane})
        .join(shared, ["_digest", "_lane"], "left")
        .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("_last")), F.col("_last")))
        .drop("_digest", "_lane", "_last")
    )


def new_folder(spark: SparkSession) -> str:
    """A new folder of the shared one, deleted when the driver ends."""
    folder = scratch_folder(spark, "archive")
    store, path = open_folder(folder)
    store.create_dir(path)
    return folder


def write_archive(pages: DataFrame, folder: str) -> DataFrame:
    """Writes ``(page_id, url, payload)`` rows as records; returns their captures, see CAPTURES."""
    decided = with_revisits(pages).select("page_id", "url", "payload", "refers_to", url_key("url").alias("surt"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_folder(folder)
        task = TaskContext.get()
        name, out, at, rolled = "", None, 0, 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                if out is None or at >= ROLL:
                    if out is not None:
                        out.close()
                    name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{rolled}.warc.gz"
                    out, at, rolled = store.open_output_stream(f"{path}/{name}", compression=None), 0, rolled + 1
                data = make_record(row["page_id"], row["url"], row["payload"], row["refers_to"])
                out.write(data)
                rows.append((row["surt"], row["page_id"], name, at, len(data)))
                at += len(data)
            columns = list(zip(*rows)) or [[]] * 5
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["surt", "page_id", "file", "offset", "length"]
            )
        if out is not None:
            out.close()

    return stash(decided.mapInArrow(write, CAPTURES))


def write_index(captures: DataFrame, folder: str) -> list[tuple[tuple, str]]:
    """Writes the index; returns the first key and the name of each part, in order.

    One entry per partition of the sort comes to the driver, whatever the number of captures.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        writer, first = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if writer is None:
                    writer = IndexWriter(folder, f"index-{task.partitionId():05d}-{task.taskAttemptId()}")
                    first = row
                writer.add(row["surt"], row["page_id"], row["file"], row["offset"], row["length"])
        if writer is not None:
            writer.close()
            yield pa.RecordBatch.from_arrays(
                [pa.array([first["surt"]]), pa.array([first["page_id"]], pa.int64()), pa.array([writer.name])],
                names=["surt", "page_id", "name"],
            )

    parts = captures.orderBy("surt", "page_id").mapInArrow(write, "surt string, page_id long, name string").collect()
    return sorted((index_key(r["surt"], r["page_id"]), r["name"]) for r in parts)


def find_captures(keys: DataFrame, folder: str, parts: list[tuple[tuple, str]]) -> DataFrame:
    """The captures of ``(surt, page_id)`` keys; keys not in the index give no rows.

    Keys are sorted over all tasks first, so each reads a stretch of the index once and in order.
    """
    shared = keys.sparkSession.sparkContext.broadcast(parts)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = IndexReader(folder, shared.value)
        for batch in batches:
            found = [line for row in batch.to_pylist() for line in reader.find(row["surt"], row["page_id"])]
            columns = list(zip(*found)) or [[]] * 5
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["surt", "page_id", "file", "offset", "length"]
            )

    asked = keys.select("surt", F.col("page_id").cast("long").alias("page_id")).distinct()
    return asked.orderBy("surt", "page_id").mapInArrow(find, CAPTURES)


def read_captures(captures: DataFrame, folder: str) -> DataFrame:
    """The records of captures, see RECORDS: ranges are read in the order of the files.

    The captures are written first, and dealt by file and offset to as many tasks as their records
    have TASK_BYTES; by their own size, a line a record, one task would read a large archive.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = open_folder(folder)
        name, file = None, None
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())]
        )
        for batch in batches:
            rows = batch.to_pylist()
            for a in range(0, len(rows), 500):
                records = []
                for row in rows[a : a + 500]:
                    if row["file"] != name:
                        name = row["file"]
                        file = store.open_input_file(f"{path}/{name}")
                    records.append(read_record(file.read_at(row["length"], row["offset"])))
                yield pa.RecordBatch.from_pylist(records, schema=schema)

    found = stash(captures.select("file", "offset", "length"))
    total = found.agg(F.sum("length")).first()[0] or 0
    tasks = max(int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK_BYTES))
    dealt = found.repartitionByRange(tasks, "file", "offset").sortWithinPartitions("file", "offset")
    return dealt.mapInArrow(read, RECORDS)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null pages are empty payloads. The archive is written, indexed, looked up and read."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload")
    )
    folder = new_folder(spark)
    parts = write_index(write_archive(pages, folder), folder)
    keys = pages.select(url_key("url").alias("surt"), "page_id")
    return read_captures(find_captures(keys, folder, parts), folder).drop("url", "payload")


OP6_SQL = """
WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes,
      sha1(coalesce(html, '')) AS payload_digest FROM pages),
m AS (SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest HAVING count(*) > 1)
SELECT page_id, payload_bytes, p.payload_digest,
  CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM p LEFT JOIN m ON p.payload_digest = m.payload_digest AND payload_bytes >= 1000
"""
