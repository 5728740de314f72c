"""Main text of web pages."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.llm.common import table
from fraudlake.llm.line_blocks import main_text


def extract_text(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """``keep`` columns and ``text``, the main text of each page: see ``line_blocks``.

    Null and empty pages, and pages of furniture alone, give an empty text; a block that only its marks
    make furniture is none if it holds most of the page's text. Rows are not shuffled; a page is read
    whole by the task that has it.
    """
    names = [f"k{i}" for i in range(len(keep))]
    narrow = pages.select(*(F.col(c).alias(n) for c, n in zip(keep, names)), F.col(html).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array((main_text(v.as_py()) for v in batch.column("html")), pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), texts], names=[*names, "text"]
            )

    schema = ", ".join([*(f"{n} {narrow.schema[n].dataType.simpleString()}" for n in names), "text string"])
    out = narrow.mapInArrow(run, schema)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "text")


def op5_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract_text(table(spark, sf_dir, "pages"), ["page_id", "url"])
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))
