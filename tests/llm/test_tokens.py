import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fraudlake.llm import merging
from fraudlake.llm.common import table
from fraudlake.llm.merging import Merger
from fraudlake.llm.tokens import op10_tokens, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture
def merger():
    with open(PATH, encoding="utf-8") as file:
        return Merger(file.read())


def wanted(library, texts):
    return [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_counts_against_the_library(library, merger):
    rng = random.Random(5)
    alphabet = list("ab cd\n\t  1'srveltdm.,!<|>éß日本  \u0085\u001c‍😀") + ["<|endoftext|>", " ", "the ", "  "]
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 60))) for _ in range(4000)]
    texts += ["", " ", "x" * 5000, "=" * 3001, " " * 999, "ab" * 3000, "a\n \n b", "\n \n", "<|endoftext|>" * 3]
    assert merger.counts(texts) == wanted(library, texts)


def test_every_code_point(library, merger):
    texts = [f"a{chr(c)}1{chr(c)} {chr(c)}b" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    assert merger.counts(texts) == wanted(library, texts)


def test_small_stores_and_parts_change_nothing(library, merger, monkeypatch):
    rng = random.Random(6)
    texts = ["".join(rng.choices("abcde fgh,", k=300)) for _ in range(50)]
    monkeypatch.setattr(merging, "KNOWN", 5)
    monkeypatch.setattr(merging, "CHUNK", 50)
    got = [n for i in range(0, 50, 7) for n in merger.counts(texts[i : i + 7])]
    assert got == wanted(library, texts)


def test_query_on_the_table(spark, sf_dir, library):
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    want = {
        r.doc_id: (len(r.text.encode()), n, n > 512)
        for r, n in zip(rows, wanted(library, [r.text for r in rows]))
    }
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op10_tokens(spark, sf_dir).collect()}
    assert got == want


def test_hard_rows(spark, library):
    rows = [(1, None), (None, ""), (2, "é x"), (2, "é x"), (3, "long " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"k0": F.lit(1), "n_tokens": F.lit("x")})
    got = sorted(map(tuple, token_counts(docs, PATH, ["doc_id"]).collect()), key=str)
    want = [(i, len((t or "").encode()), n) for (i, t), n in zip(rows, wanted(library, [t or "" for _, t in rows]))]
    assert got == sorted(want, key=str)
    assert token_counts(docs.limit(0), PATH, ["doc_id"]).count() == 0
