"""Collocations: frequent phrases of two to four words by language, scored by how bound their parts are.

A phrase can only be frequent if its parts are (Apriori). Words are counted first; then, level by level,
phrases whose parts passed the level before are counted by a hash of theirs, and hashes that are frequent
make a bit filter for the next level. What passes the filters of all its parts is a candidate; every
frequent phrase is one, and few others are. Every task tallies the candidates of its texts and deals them to
blocks of bounded size by a hash of the phrase. A block's task builds the double-array trie of its phrases; numpy
advances the states of all tallied phrases through it level by level and adds their counts at accepting
cells. All occurrences of a phrase are in one block, so the sums are exact, and texts are read five times in all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fraudlake.llm.common import stash, table
from fraudlake.llm.decontaminate import bit_filter, passes
from fraudlake.llm.phrase_tries import LONGEST, PhraseTrie, PieceWords, Tally, distinct_rows, piece_batches, row_hashes, summed
from fraudlake.llm.word_grams import Hasher

LEAST = 30
TOP = 2000
COVERED = 80  # per cent of a phrase's occurrences
SCALE = 2_000_000
BLOCK_PHRASES = 1 << 18
HELD = 1 << 20  # hashes held by a task before it hands them on
SENT = 1 << 15  # phrases handed on at once
PART_KEYS = 1 << 20  # occurrences whose hashes go to one part


def scan(texts: DataFrame, seed: int, schema: str, start: Callable) -> DataFrame:
    """The record batches that ``each(langs, salts, words)`` makes of every run of texts, and ``end()`` at
    the end; ``start()`` makes both, for each task anew."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, (each, end) = Hasher(), start()
        for batch in batches:
            for langs, salts, words in piece_batches(batch, hasher, seed):
                yield from each(langs, salts, words)
        yield from end()

    return texts.mapInArrow(run, schema)


def word_counts(texts: DataFrame) -> tuple[DataFrame, int]:
    """``(lang, gram, code, word, n)`` of all words, and the seed of the hashes, under which no two words of a
    language have the same hash: all words are compared, and another seed is taken if two meet."""

    def start():
        def each(langs: list[str], salts: np.ndarray, words: PieceWords) -> Iterator[pa.RecordBatch]:
            all_grams = words.grams(1, salts)
            _, first, of, n = np.unique(all_grams, return_index=True, return_inverse=True, return_counts=True)
            odd = words.differ(first[of])  # other words of the same hash, which are reported beside it
            first, n = np.concatenate((first, odd)), np.concatenate((n, np.ones(len(odd), np.int64)))
            grams = all_grams[first]
            names = [langs[i] for i in words.owner[first].tolist()]
            codes = pa.array(words.hashes[first].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array(grams.view(np.int64)), codes, words.strings(first), pa.array(n, pa.int64())],
                names=["lang", "gram", "code", "word", "n"],
            )

        return each, lambda: ()

    for seed in range(16):
        found = scan(texts, seed, "lang string, gram long, code long, word string, n long", start)
        ends = (F.min("code").alias("code"), F.min("word").alias("word"), F.max("word").alias("other"))
        counts = stash(found.groupBy("lang", "gram").agg(F.sum("n").alias("n"), *ends))
        if counts.where("word <> other").isEmpty():
            return counts.select("lang", "gram", "code", "word", "n"), seed
    raise ArithmeticError("word hashes collide under every seed")


def passing(words: PieceWords, salts: np.ndarray, filters: list[np.ndarray]) -> list[np.ndarray]:
    """By length, the positions whose phrase of that length passes the filter of its length."""
    found = []
    for length, bits in enumerate(filters, 1):
        grams = words.grams(length, salts)
        found.append(passes(bits, grams) & (grams != 0))
    return found


def fits(passed: list[np.ndarray], grams: np.ndarray, k: int) -> np.ndarray:
    """Positions of the phrases of ``k`` words (``grams``) of whose parts, of every length, all pass."""
    good = grams != 0
    for length, own in enumerate(passed[:k], 1):
        for j in range(k - length + 1):
            good[: len(good) - j] &= own[j:]
    return np.flatnonzero(good)


def frequent_hashes(texts: DataFrame, seed: int, filters, k: int, least: int, parts: int) -> DataFrame:
    """``(gram)``: hashes under which phrases of ``k`` words, with parts that pass, occur ``least`` times."""
    low_end = np.uint64((parts << 32) - 1)  # of a hash: the number of its part, and 32 bits in the part

    def start():
        tally = Tally(least)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal tally
            tally.merge()
            of = (tally.keys >> np.uint64(32)).astype(np.int64)
            cuts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.zeros(0, np.int64)
            ends = np.append(cuts[1:], len(of))
            low, counts = tally.keys.astype(np.uint32), tally.counts.astype(np.uint8 if least < 256 else np.int64)
            spans = list(zip(cuts.tolist(), ends.tolist())) if len(of) else []
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(of[cuts], pa.int64()),
                    pa.array([low[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary()),
                ],
                names=["part", "low", "counts"],
            )
            tally = Tally(least)

        def each(langs, salts, words) -> Iterator[pa.RecordBatch]:
            grams = words.grams(k, salts)
            if tally.add(grams[fits(passing(words, salts, filters.value), grams, k)] & low_end) > HELD:
                yield from flush()

        return each, flush

    def total(held: pa.Table) -> pa.Table:
        low = np.concatenate([np.frombuffer(v.as_py(), np.uint32) for v in held["low"]])
        kind = np.uint8 if least < 256 else np.int64
        counts = np.concatenate([np.frombuffer(v.as_py(), kind) for v in held["counts"]]).astype(np.int64)
        keys, sums = summed(low, counts)
        return pa.table({"gram": pa.array((held["part"][0].as_py() << 32) + keys[sums >= least].astype(np.int64))})

    held = scan(texts, seed, "part long, low binary, counts binary", start)
    return held.groupBy("part").applyInArrow(total, "gram long")


def candidates(texts: DataFrame, seed: int, filters, blocks: int) -> DataFrame:
    """``(block, lang, size, packet, counts)``: phrases of two words and more, as hashes, all of whose parts pass.

    Every task tallies the phrases of its texts and hands them on in packets, one for each block, language and
    length. All occurrences of a phrase go to one block.
    """

    def start():
        held: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}

        def merge() -> int:
            for key, some in held.items():
                held[key] = [distinct_rows(*map(np.concatenate, zip(*some)))]
            return sum(len(some[0][0]) for some in held.values())

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, k in list(held):
                [(rows, counts)] = held.pop((lang, k))
                block = (row_hashes(rows) % np.uint64(blocks)).astype(np.int64)
                order = np.argsort(block, kind="stable")
                rows, counts, block = rows[order], counts[order], block[order]
                cuts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))[: len(block)]
                spans = list(zip(cuts.tolist(), [*cuts[1:].tolist(), len(block)]))
                step = max(1, SENT * len(spans) // max(1, len(rows)))
                for at in range(0, len(spans), step):  # in parts, as a batch is copied several times on its way
                    some = spans[at : at + step]
                    columns = [pa.array(block[cuts[at : at + step]]), pa.array([lang] * len(some)), pa.array([k] * len(some), pa.int32())]
                    columns += [pa.array([x[a:b].tobytes() for a, b in some], pa.binary()) for x in (rows, counts)]
                    yield pa.RecordBatch.from_arrays(columns, names=["block", "lang", "size", "packet", "counts"])

        def each(langs, salts, words) -> Iterator[pa.RecordBatch]:
            passed = passing(words, salts, filters.value)
            names = np.array(langs)[words.owner] if len(words.owner) else np.zeros(0, str)
            for k in range(2, LONGEST + 1):
                at = fits(passed, words.grams(k, salts), k)
                for lang in np.unique(names[at]).tolist():
                    some = at[names[at] == lang]
                    rows = np.stack([words.hashes[some + j] for j in range(k)], axis=1)
                    held.setdefault((lang, k), []).append(distinct_rows(rows, np.ones(len(rows), np.int64)))
            if sum(len(rows) for some in held.values() for rows, _ in some) > HELD and merge() > HELD // 2:
                yield from flush()

        def end() -> Iterator[pa.RecordBatch]:
            merge()
            yield from flush()

        return each, end

    return scan(texts, seed, "block long, lang string, size int, packet binary, counts binary", start)


def trie_counts(packets: DataFrame) -> DataFrame:
    """``(lang, words, a)``: the occurrences of every phrase in ``packets``, its words as hashes.

    A task builds the trie of the different phrases of a block and takes all packets of the block through it. The
    texts are not read again, so the work grows with the number of phrases and not with the number of tries.
    """

    def count(block: pa.Table) -> pa.Table:
        held: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for lang, size, packet, counts in zip(*(block[name] for name in ("lang", "size", "packet", "counts"))):
            rows = np.frombuffer(packet.as_py(), np.uint64).reshape(-1, size.as_py())
            held.setdefault((lang.as_py(), size.as_py()), []).append((rows, np.frombuffer(counts.as_py(), np.int64)))
        langs, phrases, taken = [], [], []
        for (lang, size), some in held.items():
            taken.append((lang, *map(np.concatenate, zip(*some))))
            different, _ = distinct_rows(*taken[-1][1:])
            langs += [lang] * len(different)
            phrases += different.view(np.int64).tolist()
        trie = PhraseTrie.built(langs, phrases)
        sums = np.zeros(len(phrases), np.int64)
        for lang, rows, counts in taken:
            trie.add(lang, rows, counts, sums)
        return pa.table({"lang": pa.array(langs, pa.string()), "words": pa.array(phrases, pa.list_(pa.int64())), "a": pa.array(sums)})

    return packets.groupBy("block").applyInArrow(count, "lang string, words array<long>, a long")


def frequent_phrases(texts: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, a)`` of phrases of two to four words with ``a >= least``, and all words' counts."""
    spark = texts.sparkSession
    words, seed = word_counts(texts)
    total = words.agg(F.sum("n")).first()[0] or 0
    parts = 1 << max(0, (total // PART_KEYS).bit_length())
    filters = [bit_filter(words.where(F.col("n") >= least).select("gram"))]
    frequent = 0
    for k in range(2, LONGEST + 1):
        shared = spark.sparkContext.broadcast(list(filters))
        grams = stash(frequent_hashes(texts, seed, shared, k, least, parts))
        shared.destroy()
        filters.append(bit_filter(grams))
        frequent += grams.count()
    shared = spark.sparkContext.broadcast(filters)
    blocks = max(parts, -(-frequent // BLOCK_PHRASES))
    counted = trie_counts(candidates(texts, seed, shared, blocks)).where(F.col("a") >= least)
    listed = stash(counted.withColumn("id", F.monotonically_increasing_id()))
    shared.destroy()
    said = listed.select("id", "lang", "a", F.posexplode("words").alias("at", "code")).join(words.select("lang", "code", "word"), ["lang", "code"])
    named = said.groupBy("id", "lang", "a").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("said"))
    return stash(named.select("lang", F.array_join("said.word", " ").alias("phrase"), "a")), words


def part(first: Column | int, length: Column | int) -> Column:
    return F.array_join(F.slice("words", first, length), " ")


def collocations(rows: DataFrame, least: int = LEAST, top: int = TOP, text: str = "text", lang: str = "lang") -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the best ``top`` phrases of every language.

    Texts are lower-cased (A-Z), cut at ``.,;:!?`` and line ends into pieces and those at spaces and tabs
    into words. A phrase with ``a >= least`` is scored by its worst cut: ``a`` against the counts ``l`` and
    ``r`` of both parts. It gives way to a longer one that has it in COVERED per cent of its
    occurrences or more. All numbers are exact. A null text is empty, a null language ``und``. Repeated
    rows count as often as they occur. A long text is scanned as one row. Other columns are not
    read. Without words there are no rows.
    """
    texts = rows.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    phrases, words = frequent_phrases(texts, least)
    known = phrases.unionByName(words.where(F.col("n") >= least).select("lang", F.col("word").alias("phrase"), F.col("n").alias("a")))
    split = phrases.withColumn("words", F.split("phrase", " ", -1)).withColumn("size", F.size("words"))
    cuts = split.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns({"first": part(1, F.col("cut")), "rest": part(F.col("cut") + 1, F.col("size") - F.col("cut"))})
    lefts = known.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    rights = known.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    whole = "CAST(a AS DECIMAL(20, 0)) * CAST({} AS DECIMAL(10, 0)) div (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))"
    scored = cuts.join(lefts, ["lang", "first"]).join(rights, ["lang", "rest"]).withColumn("score", F.expr(whole.format(SCALE)))
    worst = F.min_by(F.struct("l", "r", "score"), F.struct("score", "cut"))
    scored = scored.groupBy("lang", "phrase", "a").agg(worst.alias("worst")).select("lang", "phrase", "a", "worst.*")

    spans = split.where("size > 2").select("lang", "words", "size", F.col("a").alias("longer"))
    spans = spans.withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    spans = spans.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    inside = spans.select("lang", part(F.col("at"), F.col("length")).alias("phrase"), "longer").groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(F.expr(f"coalesce(100 * longer < {COVERED} * a, true)"))

    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, 'und') AS lang, regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
p AS (SELECT lang, row_number() OVER () AS piece, regexp_extract_all(q, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(pieces) AS q FROM d) AS x),
o AS (SELECT lang, piece, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM p),
n AS (SELECT lang, w1, lead(w1, 1) OVER z AS w2, lead(w1, 2) OVER z AS w3, lead(w1, 3) OVER z AS w4 FROM o
      WINDOW z AS (PARTITION BY piece ORDER BY i)),
g AS (SELECT lang, 1 AS k, w1 AS phrase, count(*) AS a FROM n GROUP BY ALL
      UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM n WHERE w2 IS NOT NULL GROUP BY ALL
      UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM n WHERE w3 IS NOT NULL GROUP BY ALL
      UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM n WHERE w4 IS NOT NULL GROUP BY ALL),
f AS MATERIALIZED (SELECT lang, k, phrase, a FROM g WHERE a >= 30),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT lang, k, phrase, a, j, array_to_string(w[1 : j], ' ') AS head, array_to_string(w[j + 1 : k], ' ') AS rest
      FROM c, unnest(range(1, k)) AS v(j)),
s AS (SELECT cut.lang, cut.phrase, cut.a, x.a AS l, y.a AS r,
      CAST((2000000 * CAST(cut.a AS HUGEINT)) // (x.a + y.a) AS BIGINT) AS score
      FROM cut JOIN f AS x ON x.lang = cut.lang AND x.phrase = cut.head JOIN f AS y ON y.lang = cut.lang AND y.phrase = cut.rest
      QUALIFY row_number() OVER (PARTITION BY cut.lang, cut.phrase ORDER BY score, j) = 1),
sub AS (SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS longer
      FROM c, unnest(range(2, k)) AS v(m), unnest(range(1, k - m + 2)) AS u(i) GROUP BY ALL),
t AS (SELECT lang, sum(a) AS n FROM g WHERE k = 1 GROUP BY lang)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank,
  phrase, a, l, r, CAST(n AS BIGINT) AS n, score
FROM s LEFT JOIN sub USING (lang, phrase) JOIN t USING (lang) WHERE coalesce(100 * longer < 80 * a, true)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""
