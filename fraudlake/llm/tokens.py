"""Token counts of whole texts under a public byte-level vocabulary."""

from __future__ import annotations

from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.llm.common import table
from fraudlake.llm.merging import Merger

LIMIT = 512
PART = 1 << 22  # characters counted at once


def parts(texts: pa.Array) -> Iterator[list[str]]:
    """Texts in lists of about PART characters; a longer text is a list of its own."""
    held: list[str] = []
    size = 0
    for value in texts:
        text = value.as_py() or ""
        if held and size + len(text) > PART:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def token_counts(docs: DataFrame, vocabulary: str, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``n_bytes`` and ``n_tokens`` for every row.

    ``vocabulary`` is the path of a byte-level BPE file in JSON, read by the driver; its content
    (about 1.5 MB, whatever the input) is broadcast. Null and empty texts have 0 bytes and 0 tokens.
    Special strings inside a text count as one token each, none are added. Rows are not shuffled.
    """
    with open(vocabulary, encoding="utf-8") as file:
        config = docs.sparkSession.sparkContext.broadcast(file.read())
    names = [f"k{i}" for i in range(len(keep))]
    narrow = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names)), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = Merger(config.value)
        for batch in batches:
            counts = [n for part in parts(batch.column("text")) for n in merger.counts(part)]
            sizes = batch.column("text").cast(pa.binary())
            n_bytes = pa.array([len(v.as_py() or b"") for v in sizes], pa.int64())
            kept = [batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, n_bytes, pa.array(counts, pa.int64())], names=[*names, "n_bytes", "n_tokens"]
            )

    schema = ", ".join(
        [*(f"{n} {narrow.schema[n].dataType.simpleString()}" for n in names), "n_bytes long, n_tokens long"]
    )
    counted = narrow.mapInArrow(run, schema)
    return counted.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "n_bytes", "n_tokens")


def op10_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), ["doc_id"]
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > LIMIT)
