"""Benchmark decontamination by winnowing.

Method. Of every six consecutive 8-word grams the one with the smallest hash is kept, in documents
and in benchmark items. 13 words in a row shared by both contain six such grams, so both keep the
same one: no shared window is missed. Kept grams are joined on their hash, and a hit is extended
word by word to both sides, over the words themselves, so hash collisions leave no trace. Shared
spans of 13 words or more are contamination. An item shorter than 13 words is one gram of its own
length, looked for at every word.

Document grams pass a bit filter of the benchmark's grams (at most 2^28 bits, broadcast) before
they are shuffled; it only saves work. Few grams of a corpus pass, and each carries the 18 words
around it, so texts are read once and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fraudlake.llm.common import row_key, stash, table
from fraudlake.llm.word_grams import Hasher, Words, winnowed, word_batches

SPAN = 13
GRAM = 8
LEAST_BITS, MOST_BITS = 20, 28

GRAMS = pa.list_(
    pa.struct(
        [
            ("gram", pa.int64()),
            ("pos", pa.int64()),
            ("before", pa.string()),
            ("mid", pa.string()),
            ("after", pa.string()),
        ]
    )
)
GRAM_SQL = "array<struct<gram: long, pos: long, before: string, mid: string, after: string>>"


def passes(bits: np.ndarray | None, grams: np.ndarray) -> np.ndarray:
    if bits is None:
        return np.ones(len(grams), bool)
    slot = grams & np.uint64(len(bits) * 64 - 1)
    return (bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) != 0


def kept_grams(words: Words, lengths: list[int], bits: np.ndarray | None, items: bool) -> list[list[dict]]:
    """Per text, the grams to join: winnowed ones, and all grams of each short length.

    With ``items`` a text of fewer than SPAN words gives its whole sequence, no other grams.
    """
    found: list[list[dict]] = [[] for _ in words.counts]

    def add(at: int, k: int, gram: int, around: int) -> None:
        owner = int(words.owner[at])
        low = int(words.first[owner])
        high = low + int(words.counts[owner])
        found[owner].append(
            {
                "gram": gram - (1 << 64) if gram >> 63 else gram,
                "pos": at - low,
                "before": words.text(max(low, at - around), at),
                "mid": words.text(at, at + k),
                "after": words.text(at + k, min(high, at + k + around)),
            }
        )

    places = winnowed(words, GRAM, SPAN - GRAM + 1)
    if len(places):
        grams = words.grams(GRAM)[places]
        for i in np.flatnonzero(passes(bits, grams)):
            add(int(places[i]), GRAM, int(grams[i]), SPAN - GRAM)
    for k in lengths:
        whole = words.whole(k)
        if not len(whole):
            continue
        # The hash of a short item's gram is set apart from a winnowed gram of the same words.
        grams = words.grams(k) ^ np.uint64(0x5DEECE66D)
        good = whole & passes(bits, grams)
        if items:
            good &= words.counts[words.owner[: len(good)]] == k
        for at in np.flatnonzero(good):
            add(int(at), k, int(grams[at]), 0)
    return found


def with_grams(
    rows: DataFrame, keep: list[str], text: str, lengths: list[int], bits: Broadcast | None, items: bool
) -> DataFrame:
    """``keep`` columns, ``n_words`` and ``grams`` of every row."""
    names = [f"k{i}" for i in range(len(keep))]
    narrow = rows.select(*(F.col(c).alias(n) for c, n in zip(keep, names)), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for a, b, words in word_batches(batch.column("text"), hasher):
                grams = kept_grams(words, lengths, bits.value if bits else None, items)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(n).slice(a, b - a) for n in names),
                        pa.array(words.counts, pa.int64()),
                        pa.array(grams, GRAMS),
                    ],
                    names=[*names, "n_words", "grams"],
                )

    schema = ", ".join([*(f"{n} {narrow.schema[n].dataType.simpleString()}" for n in names), f"n_words long, grams {GRAM_SQL}"])
    out = narrow.mapInArrow(run, schema)
    return out.select(*(F.col(n).alias(c) for n, c in zip(names, keep)), "n_words", "grams")


def bit_filter(grams: DataFrame) -> np.ndarray:
    """Bits of the low ends of all ``gram`` values, 64 to a word; about 64 bits for each gram.

    The words are OR-ed by Spark; at most 2^22 of them come to the driver.
    """
    rows = max(1, grams.count())
    size = 1 << min(MOST_BITS, max(LEAST_BITS, (64 * rows - 1).bit_length()))
    slot = F.col("gram").bitwiseAND(F.lit(size - 1))
    word = F.shiftright(slot, 6).alias("word")
    bit = F.expr(f"shiftleft(1L, cast(gram & 63 as int))")
    set_words = grams.select(word, bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(size // 64, np.uint64)
    out[set_words["word"].to_numpy()] = set_words["bits"].to_numpy().astype(np.int64).view(np.uint64)
    return out


def equal_from_start(a: Column, b: Column) -> Column:
    """How many leading entries of two arrays are equal."""
    same = F.zip_with(a, b, lambda x, y: x.eqNullSafe(y))
    miss = F.array_position(same, F.lit(False))
    return F.when(miss == 0, F.size(same)).otherwise(miss - 1)


def split_words(c: str) -> Column:
    return F.when(F.col(c) == "", F.array().cast("array<string>")).otherwise(F.split(c, " "))


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``keep`` columns, ``n_words``, ``n_hit`` and ``items`` (sorted strings) for every row of ``docs``.

    Words are runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased.
    A word is hit if it lies in a run of 13 words, or the whole sequence of a shorter item, that an
    item has too. ``items`` are the ids of those items. Null, empty and wordless texts have no words
    and no hits; wordless items occur nowhere; items with a null id hit words but are not listed.
    Repeated rows stay repeated, each with the same result. Empty tables give no rows, or no hits.
    """
    tests = stash(
        with_grams(
            benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(item_text).alias("text")),
            ["item"], "text", list(range(1, SPAN)), None, items=True,
        )
    )
    known = stash(
        tests.select("item", F.least("n_words", F.lit(SPAN)).alias("need"), F.inline("grams"))
        .drop("pos")
        .distinct()
    )
    lengths = [r[0] for r in tests.where(f"n_words between 1 and {SPAN - 1}").select("n_words").distinct().collect()]
    bits = docs.sparkSession.sparkContext.broadcast(bit_filter(known))
    digest = row_key(*dict.fromkeys([*keep, text]))
    scanned = stash(
        with_grams(
            docs.select(*(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)), F.col(text).alias("text"), digest.alias("row")),
            [*(f"c{i}" for i in range(len(keep))), "row"], "text", sorted(lengths), bits, items=False,
        )
    )
    hits = scanned.where(F.size("grams") > 0).select("row", F.inline("grams"))
    theirs = known.select(
        "item", "need", F.col("gram").alias("gram_b"), F.col("mid").alias("mid_b"),
        F.col("before").alias("before_b"), F.col("after").alias("after_b"),
    )
    left = equal_from_start(F.reverse(split_words("before")), F.reverse(split_words("before_b")))
    right = equal_from_start(split_words("after"), split_words("after_b"))
    spans = stash(
        hits.join(theirs, (F.col("gram") == F.col("gram_b")) & (F.col("mid") == F.col("mid_b")))
        .select(
            "row", "item", "need",
            (F.col("pos") - left).alias("begin"),
            (F.col("pos") + F.size(split_words("mid")) + right).alias("end"),
        )
        .where("end - begin >= need")
        .groupBy("row", "item", "begin")
        .agg(F.max("end").alias("end"))
    )
    earlier = F.max("end").over(
        Window.partitionBy("row").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    )
    covered = (
        spans.groupBy("row", "begin").agg(F.max("end").alias("end"))
        .select("row", (F.col("end") - F.greatest("begin", F.least("end", F.coalesce(earlier, F.lit(0))))).alias("n"))
        .groupBy("row").agg(F.sum("n").alias("n_hit"))
    )
    listed = (
        spans.where("item is not null").select("row", "item").distinct()
        .groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    )
    named = [F.col(f"c{i}").alias(c) for i, c in enumerate(keep)]
    none = F.array().cast("array<string>")
    clean = scanned.where(F.size("grams") == 0).select(*named, "n_words", F.lit(0).cast("long").alias("n_hit"), none.alias("items"))
    touched = (
        scanned.where(F.size("grams") > 0).drop("grams")
        .join(covered, "row", "left").join(listed, "row", "left")
        .select(*named, "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", none).alias("items"))
    )
    return clean.unionByName(touched)


def contaminated() -> Column:
    """At least one word hit and at least a twentieth of the words."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


OP1_SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS k,
      array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS g
      FROM b, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS u(i) WHERE len(w) > 0),
ks AS (SELECT DISTINCT k FROM bw),
dw AS (SELECT r, k, i, array_to_string(w[i : i + k - 1], ' ') AS g
      FROM d, ks, unnest(range(1, len(w) - k + 2)) AS u(i)),
h AS (SELECT r, k, i, item_id FROM dw JOIN bw USING (k, g)),
p AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT DISTINCT r, k, i FROM h) AS x, unnest(range(i, i + k)) AS v(j) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS l
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS t FROM h WHERE item_id IS NOT NULL) AS y GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(l, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN s USING (r)
"""
