import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fraudlake.llm import chunk_codes, codes
from fraudlake.llm.chunk_codes import ID, Coder, chunk_key, chunks_of
from fraudlake.llm.codes import encoded, op11_codes
from fraudlake.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def coder():
    with open(PATH, encoding="utf-8") as file:
        return Coder(file.read())


def random_texts(n, most, seed):
    rng = random.Random(seed)
    alphabet = list("ab cd\n\t  1'srveltdm.,!<|>éß日本  \u0085\u001c‍😀")
    alphabet += ["<|endoftext|>", "the ", "  ", "'re", "'ll", "<|endof", "text|>"]
    return ["".join(rng.choices(alphabet, k=rng.randint(0, most))) for _ in range(n)]


def wanted(library, texts):
    out = []
    for ids in (e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        decoded = library.decode(ids, skip_special_tokens=False)
        raw = np.array(ids, "<u4").tobytes()
        out.append((len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    return out


def test_codes_and_texts_against_the_library(library, coder):
    texts = random_texts(4000, 60, 5) + ["", " ", "x" * 5000, "=" * 3001, " " * 999, "ab" * 3000, "a  ", "a\n \n b", "<|endoftext|>" * 3]
    got = coder.encode(texts)
    assert [(g & ID).tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [coder.result(g) for g in got] == wanted(library, texts)


@pytest.mark.parametrize("tokens", [16, 2])
def test_joins_agree_with_the_whole_text_wherever_it_is_cut(coder, monkeypatch, tokens):
    monkeypatch.setattr(chunk_codes, "TOKENS", tokens)
    rng = random.Random(tokens)
    for text in random_texts(2500, 90, 9) + ["x" * 3000, " " * 700 + "a", "'" * 50 + "re" * 50]:
        places = sorted(rng.choices(range(len(text) + 1), k=rng.randint(0, 12)))
        places = [0, *places, len(text)]
        parts = coder.encode([text[a:b] for a, b in zip(places, places[1:])])
        assert np.array_equal(coder.joined([parts])[0], coder.encode([text])[0]), (text, places)


def test_chunks_are_bounded_and_meet_again():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijkl", k=rng.randint(2, 9))) for _ in range(3000)]
    passage = " ".join(rng.choices(words, k=4000))
    texts = [" ".join(rng.choices(words, k=k)) + passage + " ".join(rng.choices(words, k=500)) for k in (1, 50, 777)]
    texts += ["", "short", "a" * 50_000, passage]
    chunked = chunks_of(texts)
    assert ["".join(c) for c in chunked] == texts
    for text, chunks in zip(texts, chunked):
        sizes = [len(c) for c in chunks]
        assert all(chunk_codes.CHUNK_LEAST <= n <= chunk_codes.CHUNK_MOST for n in sizes[:-1])
        assert all(0 < n <= chunk_codes.CHUNK_MOST for n in sizes)
    sets = [set(map(chunk_key, chunks_of([t])[0])) for t in texts]
    assert sets == [set(map(chunk_key, c)) for c in chunked]  # neighbours in the batch change nothing
    common = sets[0] & sets[1] & sets[2] & sets[6]
    assert sum(len(c) for c in chunked[6] if chunk_key(c) in common) > 0.8 * len(passage)


def test_query_on_the_table(spark, sf_dir, library):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    want = dict(zip([r.doc_id for r in rows], wanted(library, [r.text for r in rows])))
    got = op11_codes(spark, sf_dir).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == want and len(got) == len(rows)


def test_shared_chunks_are_encoded_once_and_joined(spark, library, monkeypatch):
    rng = random.Random(1)
    words = ["".join(rng.choices("abcdefghijklé日", k=rng.randint(2, 9))) for _ in range(2000)]
    say = lambda n: " ".join(rng.choices(words, k=n))
    passages = [say(900) for _ in range(3)]
    texts = [say(rng.randint(0, 800)) + rng.choice(passages) + say(300) + rng.choice(passages) for _ in range(60)]
    texts += [say(400)] * 300 + [say(500) for _ in range(20)]
    asked = []
    kept = codes.shared_codes
    monkeypatch.setattr(codes, "shared_codes", lambda df, v: (asked.extend(map(tuple, df.select("gram", "more").collect())), kept(df, v))[1])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r[0]: tuple(r[1:]) for r in encoded(df, PATH, ["doc_id"]).collect()}
    assert got == dict(enumerate(wanted(library, texts)))
    assert len(asked) == len(set(asked)) > 10


def test_every_chunk_taken_for_shared_changes_nothing(spark, library, monkeypatch):
    monkeypatch.setattr(codes, "bit_filter", lambda grams: np.full(4, np.iinfo(np.uint64).max, np.uint64))
    texts = random_texts(30, 3000, 2)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in encoded(df, PATH, ["doc_id"]).collect()}
    assert got == dict(enumerate(wanted(library, texts)))


def test_hard_rows(spark, library):
    rows = [(1, None), (None, ""), (2, "é x"), (2, "é x"), (3, "long " * 30_000), (4, "y" * 40_000 + "z" * 40_000), (5, " " * 3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"k0": F.lit(1), "kind": F.lit("x"), "pos": F.lit(None)})
    got = sorted(map(tuple, encoded(docs, PATH, ["doc_id", "kind", "pos"]).collect()), key=str)
    want = [(i, "x", None, *w) for (i, _), w in zip(rows, wanted(library, [t for _, t in rows]))]
    assert got == sorted(want, key=str)
    assert encoded(docs.limit(0), PATH, ["doc_id"]).count() == 0
    assert encoded(docs, PATH, []).count() == len(rows)


def test_other_vocabularies_are_refused(coder):
    spec = json.loads(json.dumps(coder.spec))
    spec["normalizer"] = {"type": "Lowercase"}
    with pytest.raises(ValueError):
        Coder(json.dumps(spec))
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file, pytest.raises(ValueError):
        Coder(file.read())
