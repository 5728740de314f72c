"""Quality classifier from weak labels.

Method. Overlapping heuristic labellers vote good, bad or abstain on every document. From how their
votes agree, expectation-maximisation estimates each labeller's accuracy and the posterior of every
vote pattern; no labelled rows are used. The posteriors are the targets of a logistic scorer on
hashed features, which then scores all documents, also those on which every labeller abstains.

Votes are counted over all documents: at most 4^9 patterns come to the driver,
in practice some dozens. The scorer is fitted
on a bounded sample, chosen by a hash of the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.llm.common import different_texts, drawn_texts, table
from fraudlake.llm.quality_signals import LABELLERS, Scorer, estimate, features, signals, votes
from fraudlake.llm.word_grams import LOWER, Hasher, Words, text_parts

SAMPLE = 6000  # about so many documents fit the scorer
KEEP_FROM = 0.4  # in doubt a document stays


def voted(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``pattern``, the votes on each row."""
    names = [f"k{i}" for i in range(len(keep))]
    narrow = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names)), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for a, b, data, offsets in text_parts(batch.column("text")):
                pattern = votes(signals(data, offsets, Words(LOWER[data], offsets, hasher)))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n).slice(a, b - a) for n in names), pa.array(pattern, pa.int64())],
                    names=[*names, "pattern"],
                )

    schema = ", ".join([*(f"{n} {narrow.schema[n].dataType.simpleString()}" for n in names), "pattern long"])
    out = narrow.mapInArrow(run, schema)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "pattern")


def fit_scorer(docs: DataFrame, posterior: dict[int, float], text: str = "text", about: int = SAMPLE) -> Scorer:
    """A scorer for the posteriors of the votes on at most ``about`` different texts, each taken once."""
    rows = docs.select(F.col(text).alias("text")).where("text is not null")
    sample = drawn_texts(rows, different_texts(rows), about)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for _, _, data, offsets in text_parts(batch.column("text")):
                words = Words(LOWER[data], offsets, hasher)
                of, feature, value = features(data, offsets, words)
                ends = np.searchsorted(of, np.arange(len(offsets))).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(x))
                    for x in (feature.astype(np.int32), value.astype(np.float32))
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(votes(signals(data, offsets, words))), *lists], names=["pattern", "feature", "value"]
                )

    found = sample.mapInArrow(run, "pattern long, feature array<int>, value array<float>").toArrow()
    scorer = Scorer()
    if len(found):
        feature = found["feature"].combine_chunks()
        of = np.repeat(np.arange(len(found)), np.diff(feature.offsets.to_numpy()))
        value = found["value"].combine_chunks().flatten().to_numpy()
        target = np.array([posterior[p] for p in found["pattern"].to_pylist()])
        scorer.fit(of, feature.flatten().to_numpy(), value, target)
    return scorer


def with_score(docs: DataFrame, scorer: Scorer, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns and ``score`` (0 to 1, 1: good) for every row."""
    names = [f"k{i}" for i in range(len(keep))]
    narrow = docs.select(*(F.col(c).alias(n) for c, n in zip(keep, names)), F.col(text).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(scorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for a, b, data, offsets in text_parts(batch.column("text")):
                score = shared.value.scores(data, offsets, Words(LOWER[data], offsets, hasher))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(n).slice(a, b - a) for n in names), pa.array(score, pa.float64())],
                    names=[*names, "score"],
                )

    schema = ", ".join([*(f"{n} {narrow.schema[n].dataType.simpleString()}" for n in names), "score double"])
    out = narrow.mapInArrow(run, schema)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "score")


def classify(docs: DataFrame, keep: list[str], text: str = "text") -> tuple[DataFrame, dict[str, float]]:
    """Scores of all rows, and the estimated accuracy of each labeller.

    The frame: ``keep`` columns, ``score`` and ``keep_it``, whether the score is at least KEEP_FROM.
    Null, empty and wordless texts have nothing to be scored by and get the score 0. Repeated rows
    get equal scores. An empty table gives no rows.
    """
    counted = voted(docs, [], text).groupBy("pattern").count().toArrow()
    patterns, counts = counted["pattern"].to_numpy(), counted["count"].to_numpy()
    good, accuracies, _ = estimate(patterns, counts)
    posterior = dict(zip(patterns.tolist(), good.tolist()))
    scorer = fit_scorer(docs, posterior, text)
    empty = ~F.coalesce(F.col("_text_known"), F.lit(False))
    known = docs.withColumn("_text_known", F.col(text).rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
    scored = with_score(known, scorer, [*keep, "_text_known"], text)
    score = F.when(empty, 0.0).otherwise(F.col("score"))
    frame = scored.withColumn("score", score).withColumn("keep_it", F.col("score") >= KEEP_FROM).drop("_text_known")
    return frame, dict(zip(LABELLERS, accuracies.tolist()))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame, _ = classify(table(spark, sf_dir, "documents"), ["doc_id"])
    return frame.withColumnRenamed("keep_it", "keep")
