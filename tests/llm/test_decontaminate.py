import random
import re

import duckdb
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fraudlake.llm import word_grams
from fraudlake.llm.common import table
from fraudlake.llm.decontaminate import OP1_SQL, contamination, op1_decontaminate
from fraudlake.llm.word_grams import Hasher, winnowed, word_batches

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        k = min(13, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + k]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for k in {len(g) for g in windows}:
            for i in range(len(w) - k + 1):
                if tuple(w[i : i + k]) in windows:
                    hit.update(range(i, i + k))
                    found |= windows[tuple(w[i : i + k])]
        out.append((doc, len(w), len(hit), sorted(str(i) for i in found if i is not None)))
    return sorted(out, key=str)


def run(spark, docs, items):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"row": F.lit(1), "n_words": F.lit("x"), "item": F.lit(2)})
    b = spark.createDataFrame(items, "item_id long, text string").withColumns({"gram": F.lit(1), "need": F.lit(0)})
    return sorted(((r[0], r[1], r[2], list(r[3])) for r in contamination(d, b, ["doc_id"]).collect()), key=str)


def test_against_all_windows(spark):
    rng = random.Random(3)
    pool = ["a", "b", "the", "é", "x1"] + [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choices(pool, k=rng.choice([1, 3, 7, 12, 13, 14, 30, 60])))) for i in range(30)]
    items += [(98, None), (99, ""), (None, " ".join(f"q{i}" for i in range(20))), (50, items[8][1]), (51, "a " * 40)]
    docs = []
    for i in range(80):
        parts = []
        for _ in range(rng.randint(0, 5)):
            w = words(rng.choice(items)[1])
            a = rng.randint(0, max(0, len(w) - 1))
            parts += [*rng.choices(pool, k=rng.randint(0, 30)), *w[a : a + rng.randint(1, 40)]]
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(parts).upper()))
    docs += [(7, docs[7][1]), (7, docs[3][1]), (None, docs[5][1]), (200, None), (201, ""), (202, "?!"), (203, "A " * 3000)]
    docs.append((204, " ".join(f"q{i}" for i in range(20))))
    assert run(spark, docs, items) == plain(docs, items)


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a b c")]) == []
    assert run(spark, [(1, "a b c")], []) == [(1, 3, 0, [])]


def test_parts_change_nothing(monkeypatch):
    rng = random.Random(4)
    texts = pa.array([" ".join(rng.choices(["ab", "Cd", "é", "x" * 30], k=rng.randint(0, 40))) for _ in range(30)])
    def grams():
        return [
            (a + o, int(g)) for a, _, w in word_batches(texts, Hasher()) for o, g in zip(w.owner[: max(0, len(w.hashes) - 2)][w.whole(3)], w.grams(3)[w.whole(3)])
        ]
    want = grams()
    monkeypatch.setattr(word_grams, "PART", 50)
    assert grams() == want
    assert [len(words(t)) for t in texts.to_pylist()] == [c for _, _, w in word_batches(texts, Hasher()) for c in w.counts]


def test_winnowing_keeps_one_gram_of_every_window():
    rng = np.random.default_rng(1)
    texts = pa.array([" ".join(map(str, rng.integers(0, 9, 200))), "a b", " ".join(["z"] * 50)])
    (_, _, w), = word_batches(texts, Hasher())
    places = set(winnowed(w, 8, 6).tolist())
    whole = w.whole(13)
    assert all(places & set(range(i, i + 6)) for i in np.flatnonzero(whole))


def test_query_against_sql(spark, sf_dir):
    for name in ("documents", "benchmark"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    want = sorted(duckdb.sql(OP1_SQL).fetchall())
    assert sorted(map(tuple, op1_decontaminate(spark, sf_dir).collect())) == want
    assert any(r[5] for r in want)
