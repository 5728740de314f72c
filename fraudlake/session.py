"""Session helpers."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


#: Paths of the copies that ``materialize`` made and nothing has deleted yet.
_copies: list[str] = []


def build_session(app_name: str = "fraudlake", **conf: str) -> SparkSession:
    """A session with the settings the library relies on; master and sizes come from spark-submit."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: the one the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster a
    machine-local folder would be lost with its machine, so a missing setting is an error there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current is not None:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="fraudlake-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written once as parquet to the shared checkpoint folder and read back.

    For a frame that a plan reads several times. The copy survives the loss of executors, cuts
    the lineage and can still be pruned by column. It stays until ``copies_released`` or the
    driver ends.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_folder(spark: SparkSession, kind: str) -> str:
    """The path of a new folder in the shared one, which is deleted like the copies of ``materialize``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"
    _copies.append(path)
    return path


def release(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete copies, on whatever file system they are."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files and folders in ``folder``; none if it does not exist."""
    system, path = _file_system(spark, folder)
    return [f.getPath().getName() for f in system.listStatus(path)] if system.exists(path) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, target = _file_system(spark, path)
    stream = system.create(target)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Renames a file; an error if ``to`` exists or the file system refuses."""
    system, source = _file_system(spark, path)
    target = _file_system(spark, to)[1]
    if system.exists(target) or not system.rename(source, target):
        raise FileExistsError(f"{path} could not be renamed to {to}")


def release_copy(df: DataFrame) -> None:
    """Delete a copy that ``materialize`` made and nothing reads any more."""
    path = next((p for p in _copies if any(p.split("/")[-1] in f for f in df.inputFiles()[:1])), None)
    if path is not None:
        _copies.remove(path)
        release(df.sparkSession, [path])


@contextlib.contextmanager
def copies_released(spark: SparkSession) -> Iterator[None]:
    """Deletes the copies that were made inside, for a step whose results have been written."""
    start = len(_copies)
    try:
        yield
    finally:
        made = _copies[start:]
        del _copies[start:]
        release(spark, made)


@atexit.register
def _release_at_exit() -> None:
    spark = SparkSession.getActiveSession() if _copies else None
    if spark is not None:
        with contextlib.suppress(Exception):  # the session may be ending
            release(spark, _copies)


_ARROW_TYPES = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
}


def small_table(spark: SparkSession, rows: Sequence[Sequence], schema: str) -> DataFrame:
    """A few driver-side rows (fitted values, listings) as a DataFrame, without Python tasks.

    ``schema`` is a list such as ``"name string, rank long"``.
    """
    fields = [field.split() for field in schema.split(",")]
    columns = [
        pa.array([row[i] for row in rows], _ARROW_TYPES[kind])
        for i, (_, kind) in enumerate(fields)
    ]
    return spark.createDataFrame(pa.table(columns, names=[name for name, _ in fields]))
