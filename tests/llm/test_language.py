import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlake.llm.common import different_texts, drawn_texts, table
from fraudlake.llm.language import learn, op7_language, with_language
from fraudlake.llm.language_filter import LanguageFilter, grams, letters


def arrays(texts):
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)])


def test_letters_and_grams():
    low, owner = letters(*arrays(["Ab, 1é!", "", "x"]))
    assert low.tobytes().decode() == " ab é   x " and owner.tolist() == [0] * 7 + [1] + [2] * 3
    packed, of = grams(low, owner, 3)
    assert [int(p).to_bytes(4, "big")[1:] for p in packed] == [" ab".encode(), b"ab ", b"b \xc3", " é".encode(), "é ".encode(), b" x "]
    assert of.tolist() == [0] * 5 + [2]


def test_filter_has_every_member_and_corrects_false_hits():
    rng = np.random.default_rng(0)
    members = rng.integers(0, 1 << 40, 6000).astype(np.uint64)
    language = rng.integers(0, 11, 6000)
    model = LanguageFilter([f"l{i}" for i in range(11)], 14)
    model.add(members, language)
    for i in range(11):
        own = members[language == i]
        assert model.hits(own, np.zeros(len(own), np.int64), 1)[0, i] == len(own)
    strange = rng.integers(1 << 41, 1 << 42, 20_000).astype(np.uint64)
    found = model.hits(strange, np.zeros(20_000, np.int64), 1)[0] / 20_000
    assert np.abs(found - model.false_rates()).max() < 0.01


def test_held_out_accuracy_on_the_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op7_language(spark, sf_dir).collect()}
    rows = table(spark, sf_dir, "documents").collect()
    assert len(got) == len(rows)
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    tested = [r for r in rows if got[r.doc_id].held_out]
    right = sum(got[r.doc_id].lang_pred == r.lang for r in tested)
    assert right / len(tested) >= 0.98 and all(0 <= r.score <= 1 for r in got.values())


def test_hard_rows(spark):
    rng = random.Random(1)
    words = {"aa": ["kota", "mira", "sol"], "bb": ["xqwz", "vprt"], "c": ["éüß", "ñandú"]}
    rows = [(i, " ".join(rng.choices(words[l], k=30)), l) for i, l in enumerate(["aa", "bb", "c"] * 40)]
    docs = spark.createDataFrame([*rows, (None, "kota", None), (500, None, "aa")], "doc_id long, text string, lang string")
    model = learn(docs)
    assert model.languages[0] == "aa" and len(model.languages) == 3
    asked = [(1, None), (2, ""), (3, "12 %%"), (4, "KOTA mira"), (None, "xqwz"), (None, "xqwz"), (5, "é" * 50_000), (6, "ñandú"), (7, "zzzz")]
    got = with_language(spark.createDataFrame(asked, "doc_id long, text string").withColumn("score", F.lit("x")), model, ["doc_id"])
    found = sorted(((r.doc_id is None, r.doc_id or 0, r.lang_pred, r.score) for r in got.collect()))
    assert [f[2] for f in found if f[1] in (1, 2, 3, 4, 6)] == ["und", "und", "und", "aa", "c"]
    assert [f[2] for f in found if f[0]] == ["bb", "bb"] and all(s == 0 for _, i, _, s in found if i in (1, 2, 3, 7))
    assert with_language(docs.limit(0), model, ["doc_id"]).count() == 0
    empty = learn(docs.limit(0))
    assert {r.lang_pred for r in with_language(docs, empty, ["doc_id"]).collect()} == {"und"}


@pytest.mark.parametrize("text", ["kota mira sol", "the same words", "xq", "año nuevo", "z z z", "many of one", "eight", "a b c d"])
def test_a_language_of_one_repeated_text_is_learned(spark, text):
    rows = [("aa", f"vprt number {chr(97 + i % 26)}{chr(97 + i // 26)}") for i in range(600)] + [("zz", text)] * 3000
    model = learn(spark.createDataFrame(rows, "lang string, text string"), about=100)
    assert model.languages == ["zz", "aa"]
    got = with_language(spark.createDataFrame([(text,)], "text string"), model, ["text"]).first()
    assert got.lang_pred == "zz" and got.score > 0.9


def test_draw_is_bounded_and_takes_each_text_once(spark):
    rows = [("aa", f"text {i}") for i in range(2000)] + [("aa", "hot")] * 1000 + [("bb", "x"), ("bb", "x"), ("bb", "y")]
    frame = spark.createDataFrame(rows, "lang string, text string")
    drawn = drawn_texts(frame, different_texts(frame, ["lang"]), 50, ["lang"]).collect()
    assert sorted(r.text for r in drawn if r.lang == "bb") == ["x", "y"]
    assert len({r.text for r in drawn if r.lang == "aa"}) == 50 == sum(r.lang == "aa" for r in drawn)
    digests = sorted((hashlib.md5(t.encode()).hexdigest(), t) for t in {t for _, t in rows})
    whole = drawn_texts(frame, different_texts(frame), 70)
    assert sorted(r.text for r in whole.collect()) == sorted(t for _, t in digests[:70])


def test_too_many_languages_are_refused(spark):
    rows = spark.createDataFrame([(f"l{i}", "a text") for i in range(9)], "lang string, text string")
    assert len(learn(rows, most=9).languages) == 9
    with pytest.raises(ValueError, match="more than 8 languages"):
        learn(rows, most=8)


def test_predictions_equal_plain_counting(spark):
    """The learned sets as plain Python sets; a filter may only add false hits, which are rare and taken off."""
    rng = random.Random(3)
    words = {l: ["".join(rng.choices(a, k=5)) for _ in range(30)] for l, a in (("aa", "abcdef"), ("bb", "defghi"), ("cc", "pqrst"))}
    texts = [(l, " ".join(rng.choices(words[l], k=12))) for l in words for _ in range(60)]
    model = learn(spark.createDataFrame(texts, "lang string, text string"))
    counts = {l: Counter() for l in words}
    for l, t in texts:
        counts[l].update(f" {t} "[i : i + k] for k in (3, 5) for i in range(len(t) + 3 - k))
    share = {l: {g: n / sum(c.values()) for g, n in c.items()} for l, c in counts.items()}
    known = {
        l: {g for g, s in share[l].items() if s >= 2e-6 and s >= 0.1 * max(o.get(g, 0) for o in share.values())} for l in words
    }
    asked = [" ".join(rng.choices(words[rng.choice(list(words))], k=6)) for _ in range(200)]
    got = with_language(spark.createDataFrame([(t,) for t in asked], "text string"), model, ["text"])
    for r in got.collect():
        seen = [f" {r.text} "[i : i + k] for k in (3, 5) for i in range(len(r.text) + 3 - k)]
        plain = {l: sum(g in known[l] for g in seen) / len(seen) for l in words}
        assert plain[r.lang_pred] == max(plain.values()) and abs(r.score - plain[r.lang_pred]) < 0.02
