import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corpus_pipeline import STAGES, run
from fraudlake.llm.common import table
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_mixing import plain_targets
from tests.llm.test_sharding import plain as plain_shards
from tests.llm.test_simhash import plain_components


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Rows after each stage, as lists of Row."""
    docs, out = table(spark, sf_dir, "documents"), []
    for name, f in STAGES:
        got = f(spark, docs, sf_dir)
        out.append(got.collect())
        docs = spark.createDataFrame(out[-1], got.schema)
    return out


def plain_scores(docs):
    """Largest share of a text's n-grams in a language, by exact sets; None without a letter."""

    def grams(text):
        low = "".join(c.lower() if c.isascii() else c for c in text)
        padded = (" " + re.sub(r"[^a-z\x80-\U0010ffff]+", " ", low) + " ").encode()
        padded = re.sub(rb" +", b" ", padded)
        return [padded[i : i + n] for n in (3, 5) for i in range(len(padded) - n + 1)]

    counts = defaultdict(Counter)
    for d in docs:
        if d.text is not None and d.lang is not None:
            counts[d.lang].update(grams(d.text))
    share = {l: {g: n / c.total() for g, n in c.items()} for l, c in counts.items()}
    known = {l: {g for g, s in of.items() if s >= 2e-6 and s >= 0.1 * max(x.get(g, 0) for x in share.values())} for l, of in share.items()}
    out = {}
    for d in docs:
        if d.text is None or not any(c.isalpha() for c in d.text):
            out[d.doc_id] = None
        else:
            g = grams(d.text)
            out[d.doc_id] = max(sum(x in k for x in g) / len(g) for k in known.values())
    return out


def test_languages(spark, sf_dir, stages):
    docs = table(spark, sf_dir, "documents").collect()
    scores = plain_scores(docs)
    want = [d for d in docs if scores[d.doc_id] is not None and scores[d.doc_id] >= 0.2]
    assert sorted(stages[0]) == sorted(want) and len(want) > 0.95 * len(docs)


def test_near_duplicates(stages):
    classes = plain_components([(r.doc_id, r.text) for r in stages[0]])
    assert sorted(r.doc_id for r in stages[1]) == sorted({c for _, _, c in classes})
    assert set(stages[1]) <= set(stages[0])


def test_decontamination(spark, sf_dir, stages):
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    hits = {i: (n, h) for i, n, h, _ in plain_hits([(r.doc_id, r.text) for r in stages[1]], items)}
    want = [r for r in stages[1] if not (hits[r.doc_id][1] and 20 * hits[r.doc_id][1] >= hits[r.doc_id][0])]
    assert sorted(stages[2]) == sorted(want) and len(want) < len(stages[1])


def test_mixing(stages):
    words = lambda r: len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in stages[2]:
        sizes[r.source] += words(r)
        largest[r.source] = max(largest[r.source], words(r))
    for r in stages[3]:
        taken[r.source] += words(r)
    want = plain_targets(sizes)
    assert all(abs(taken[s] - want[s]) <= 2 * largest[s] for s in sizes)
    assert set(stages[3]) <= set(stages[2]) and max(Counter(r.doc_id for r in stages[3]).values()) <= 3


def test_shards(stages):
    want = plain_shards([r.text for r in stages[3]], 8)
    assert Counter(r[:5] for r in stages[4]) == Counter(tuple(r) for r in stages[3])
    slots = defaultdict(list)
    for r in stages[4]:
        assert r.shard == want[hashlib.md5(r.text.encode()).hexdigest()]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_run_is_the_stages(spark, sf_dir, stages):
    assert sorted(run(spark, sf_dir).collect()) == sorted(stages[-1])


def test_hard_rows_through_every_stage(spark, sf_dir):
    rows = [(1, "kota mira sol " * 9, "aa", "s", 1), (1, "kota mira sol " * 9, "aa", "s", 1), (None, None, None, None, None), (None, "xq wz " * 9, "bb", None, 2)]
    rows += [(None, "xq wz " * 9, "bb", None, 2), (5, "", "aa", "t", 0), (6, "12 34", "aa", "t", 0), (7, "long text " * 20_000, "cc", "s", 3), (8, "xq wz vq", "bb", "t", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit("x") for c in ("fp", "class", "lang_pred", "score", "size", "copies", "shard", "row", "order", "digest", "item", "k0", "c0", "target")})
    for name, f in STAGES:
        got = f(spark, docs, sf_dir)
        if name != "sharding":
            assert got.columns == docs.columns
        left = got.collect()
        assert f(spark, docs.limit(0), sf_dir).count() == 0
        docs = spark.createDataFrame(left, got.schema)
        if name == "language_id":
            assert len(left) == 6
        if name == "near_duplicates":
            assert len(left) == 4 and Counter(r.doc_id for r in left) == {1: 1, None: 1, 7: 1, 8: 1}
    assert {"shard", "slot"} <= set(docs.columns) and docs.count() > 0


def test_names():
    assert corpus_pipeline.ORACLE_SQL is None and len(STAGES) == 5


def test_texts_stay_if_no_row_names_a_language(spark, sf_dir):
    rows = [(1, "a clean text", None, "s", 12), (2, "12 34", None, "s", 5), (3, None, None, "s", 0), (4, "\u00e9t\u00e9", None, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = dict(corpus_pipeline.STAGES)["language_id"](spark, docs, sf_dir)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 4]
