import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlake.llm import phrases
from fraudlake.llm.phrase_tries import PhraseTrie, PieceWords, Tally, distinct_rows, summed
from fraudlake.llm.phrases import OP12_SQL, collocations, op12_phrases, word_counts
from fraudlake.llm.word_grams import LOWER, Hasher


def brute(rows, least, top):
    counts, total = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            counts.update((lang, *words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    out = []
    frequent = {p: a for p, a in counts.items() if a >= least and len(p) > 2}
    covered = Counter()
    for (lang, *words), a in frequent.items():
        for m in range(2, len(words)):
            for i in range(len(words) - m + 1):
                key = (lang, *words[i : i + m])
                covered[key] = max(covered[key], a)
    for (lang, *words), a in frequent.items():
        if 100 * covered[(lang, *words)] >= 80 * a:
            continue
        cuts = [(2_000_000 * a // (l + r), k, l, r) for k in range(1, len(words)) for l, r in [(counts[(lang, *words[:k])], counts[(lang, *words[k:])])]]
        score, _, l, r = min(cuts)
        out.append((lang, -score, -a, " ".join(words).encode(), l, r))
    ranked, last = [], Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        last[lang] += 1
        if last[lang] <= top:
            ranked.append((lang, last[lang], phrase.decode(), -a, l, r, total[lang], -score))
    return ranked


def random_rows(n, seed):
    rng = random.Random(seed)
    words = ["de", "la", "New", "york", "CITY", "hall", "é", "日本", "x", "a b"]
    joins = [" ", " ", " ", "\t", "  ", ", ", ".\n", "!"]
    return [("".join(rng.choice(words) + rng.choice(joins) for _ in range(rng.randint(0, 40))), rng.choice(["en", "fr", None])) for _ in range(n)]


def got(df):
    return sorted(map(tuple, df.collect()))


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string")


@pytest.mark.parametrize("least, top", [(3, 2000), (9, 7)])
def test_against_brute_force(spark, monkeypatch, least, top):
    rows = random_rows(150, least)
    monkeypatch.setattr(phrases, "BLOCK_PHRASES", 40)
    monkeypatch.setattr(phrases, "HELD", 30)
    monkeypatch.setattr(phrases, "PART_KEYS", 200)
    want = brute(rows, least, top)
    assert got(collocations(frame(spark, rows).repartition(3), least, top)) == sorted(want) and len(want) >= 3 * min(top, 20)


def test_counts_of_a_trie_are_those_of_every_position():
    rng = np.random.default_rng(0)
    names = [f"w{i}" for i in range(300)]
    text = " ".join(names[i] for i in rng.zipf(1.3, 20_000) % 300)
    low = LOWER[np.frombuffer(text.encode(), np.uint8)]
    words = PieceWords(low, np.array([0, len(low)]), Hasher(), 0)
    hash_of = dict(zip(text.split(), words.hashes.view(np.int64).tolist()))
    split = text.split()
    counted = Counter(tuple(split[i : i + k]) for k in (2, 3, 4) for i in range(len(split) - k + 1))
    asked = [p for p, _ in counted.most_common(9000)] + [("w1", "w1", "w299", "w299")]
    trie = PhraseTrie.built(["en"] * len(asked), [[hash_of[w] for w in p] for p in asked])
    assert len(trie.base) < 6 * (trie.check >= 0).sum() + 1024
    trie = PhraseTrie.of_bytes(list(trie.roots), trie.to_bytes())
    counts = np.zeros(len(asked), np.int64)
    trie.count(words, ["en"], counts)
    assert counts.tolist() == [counted[p] for p in asked]
    trie.count(words, ["fr"], counts)
    assert counts.tolist() == [counted[p] for p in asked]


def test_texts_are_read_as_often_for_many_blocks_as_for_one(spark, monkeypatch):
    rows, real, scans = random_rows(150, 3), phrases.scan, []
    monkeypatch.setattr(phrases, "scan", lambda *a: scans.append(a) or real(*a))
    found = []
    for size in (1 << 18, 20):
        monkeypatch.setattr(phrases, "BLOCK_PHRASES", size)
        found.append((got(collocations(frame(spark, rows), 3)), len(scans)))
        scans.clear()
    assert found[0] == found[1] and found[0][1] == 5 and len(found[0][0]) > 60


def test_a_trie_adds_tallied_phrases():
    asked = [("en", [3, 5]), ("en", [3, 5, 3]), ("fr", [3, 5]), ("fr", [9, 1 << 40 | 1])]
    trie = PhraseTrie.built([lang for lang, _ in asked], [p for _, p in asked])
    counts = np.zeros(4, np.int64)
    for lang, rows, times in [
        ("en", [[3, 5], [5, 3], [3, 5]], [2, 40, 1 << 60]),
        ("en", [[3, 5, 3], [3, 5, 5]], [7, 40]),
        ("fr", [[9, 1 << 40 | 1], [9, 7]], [4, 40]),
        ("de", [[3, 5]], [40]),
    ]:
        trie.add(lang, np.array(rows, np.uint64), np.array(times), counts)
    assert counts.tolist() == [(1 << 60) + 2, 7, 0, 4]
    rows, times = distinct_rows(np.array([[1, 2], [1, 3], [1, 2]], np.uint64), np.array([1, 5, 1 << 60]))
    assert rows.tolist() == [[1, 2], [1, 3]] and times.tolist() == [(1 << 60) + 1, 5]


def test_tallies_are_cut_where_the_sum_is_decided():
    tally = Tally(3)
    for keys in ([5, 5, 5, 5, 2], [2, 9], [5]):
        tally.add(np.array(keys, np.uint64))
    tally.merge()
    assert dict(zip(tally.keys.tolist(), tally.counts.tolist())) == {2: 2, 5: 3, 9: 1}
    assert all(len(a) == 0 for a in summed(np.zeros(0, np.uint64), np.zeros(0, np.int64)))


def test_word_hashes_that_meet_take_another_seed(spark, monkeypatch):
    real = phrases.piece_batches

    def worse(batch, hasher, seed):
        for langs, salts, words in real(batch, hasher, seed):
            if seed == 0:
                words.hashes[:] = words.hashes & np.uint64(1)
            yield langs, salts, words

    monkeypatch.setattr(phrases, "piece_batches", worse)
    counts, seed = word_counts(frame(spark, [("a b c d e f g", "en")]))
    assert seed == 1 and counts.count() == 7


def test_query_and_sql_agree(spark):
    sf_dir = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.sql(OP12_SQL)
    df = op12_phrases(spark, sf_dir)
    assert df.columns == want.columns
    assert got(df) == sorted(want.fetchall()) and df.count() > 100


def test_hard_rows(spark):
    rows = [(None, "en"), ("", None), ("a b " * 5000 + "c", "en"), ("a b", None), ("a b", "und")] + [("A b. c", "de")] * 40
    df = frame(spark, rows).withColumns({"gram": F.lit(1), "phrase": F.lit("x"), "n": F.lit(None)})
    assert got(collocations(df, 2)) == sorted(brute(rows, 2, 2000))
    assert collocations(df.limit(0)).count() == 0
    assert collocations(df.limit(2)).count() == 0
