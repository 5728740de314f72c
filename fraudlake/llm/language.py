"""Language identification with bitmask n-gram filters.

Method. From labelled texts the n-grams of each language are counted; those that are frequent in a
language, and not much rarer there than in the language that has them most, enter a Bloom filter of
that language. The filters are bit-sliced: a slot holds one bit per language, so a look-up returns
the set of all languages containing an n-gram. A text's hits per language are counted, corrected for
the false positives its filter gives, and the largest share decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fraudlake.llm.common import different_texts, drawn_texts, stash, table
from fraudlake.llm.language_filter import LENGTHS, LanguageFilter, grams, letters
from fraudlake.llm.word_grams import text_parts

TEXTS_PER_LANGUAGE = 4000  # so many different labelled texts of a language are learned from
MOST_LANGUAGES = 128
LEAST_SHARE = 2e-6  # of a language's n-grams
LEAST_RATIO = 0.1  # of the largest share that any language has
UNKNOWN = "und"
LEAST_SCORE = 0.2  # below it no learned language fits


def gram_counts(labelled: DataFrame) -> DataFrame:
    """``(lang, gram, n)`` of ``(text, lang)`` rows; counted per batch first, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            for a, b, data, offsets in text_parts(batch.column("text")):
                low, owner = letters(data, offsets)
                for length in LENGTHS:
                    packed, of = grams(low, owner, length)
                    for lang in sorted(set(langs[a:b])):
                        inside = (langs[a:b] == lang)[of]
                        values, counts = np.unique(packed[inside], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([lang] * len(values), pa.string()), pa.array(values.astype(np.int64)), pa.array(counts)],
                            names=["lang", "gram", "n"],
                        )

    counted = labelled.select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    about: int = TEXTS_PER_LANGUAGE,
    most: int = MOST_LANGUAGES,
) -> LanguageFilter:
    """A filter from the rows of ``labelled`` that have a text and a language.

    Of each language at most ``about`` different texts are read, chosen by their digests; that bounds
    the work and the n-grams. A text counts once however many copies it has, so every language with
    a row is learned. Languages are in the order of their number of rows, then by code point, so
    that ties go to the more frequent one. More than ``most`` languages, as a column of dirty labels
    would have, are refused: the filter takes at most 16 MB for each 8 of them.
    """
    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).where("text is not null and lang is not null")
    different = different_texts(rows, ["lang"])
    sizes = different.groupBy("lang").agg(F.sum("copies").alias("n"))
    languages = [r["lang"] for r in sizes.orderBy(F.desc("n"), "lang").limit(most + 1).collect()]
    if len(languages) > most:
        raise ValueError(f"more than {most} languages: clean the labels, or allow more of them")
    model = LanguageFilter(languages, 10)
    if not languages:
        return model
    counts = stash(gram_counts(drawn_texts(rows, different, about, ["lang"])))
    of_lang = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(of_lang), "lang").withColumn("share", F.col("n") / F.col("total"))
    shares = shares.where(F.col("share") >= LEAST_SHARE)
    most = F.max("share").over(Window.partitionBy("gram"))
    kept = shares.withColumn("most", most).where(F.col("share") >= LEAST_RATIO * F.col("most")).select("gram", "lang").toArrow()
    index = {name: i for i, name in enumerate(languages)}
    model = LanguageFilter(languages, min(24, max(16, (16 * len(kept)).bit_length())))
    model.add(
        kept["gram"].to_numpy().astype(np.int64).view(np.uint64),
        np.array([index[name] for name in kept["lang"].to_pylist()], np.int64),
    )
    return model


def with_language(docs: DataFrame, model: LanguageFilter, keep: list[str], text: str = "text") -> DataFrame:
    """``keep`` columns, ``lang_pred`` and ``score`` for every row.

    The score is the share of the text's n-grams that the language contains. Null texts and texts
    without a letter get ``und`` and 0, and so does every text if nothing was learned. Rows are not
    shuffled; the model, at most 16 MB for each 8 languages, is broadcast.
    """
    names = [f"k{i}" for i in range(len(keep))]
    narrow = docs.select(
        *(F.col(c).alias(n) for c, n in zip(keep, names)),
        F.when(F.col(text).rlike(r"\p{L}"), F.col(text)).alias("text"),
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        languages = np.array([*model.languages, UNKNOWN], dtype=object)
        for batch in batches:
            known = batch.column("text").is_valid().to_numpy(zero_copy_only=False)
            for a, b, data, offsets in text_parts(batch.column("text")):
                shares = model.shares(data, offsets)
                best = shares.argmax(axis=1) if model.languages else np.zeros(b - a, np.int64)
                score = shares.max(axis=1) if model.languages else np.zeros(b - a)
                best[~known[a:b]], score[~known[a:b]] = len(model.languages), 0
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(n).slice(a, b - a) for n in names),
                        pa.array(languages[best], pa.string()),
                        pa.array(score, pa.float64()),
                    ],
                    names=[*names, "lang_pred", "score"],
                )

    schema = ", ".join(
        [*(f"{n} {narrow.schema[n].dataType.simpleString()}" for n in names), "lang_pred string, score double"]
    )
    out = narrow.mapInArrow(run, schema)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "lang_pred", "score")


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learned_from(docs: DataFrame) -> LanguageFilter:
    """The model of all labelled documents that are not held out."""
    return learn(docs.where(~held_out()))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    predicted = with_language(docs, learned_from(docs), ["doc_id"])
    return predicted.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
