import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from fraudlake.llm.common import table
from fraudlake.llm.quality import classify, op3_quality
from fraudlake.llm.quality_signals import ABSTAIN, BAD, GOOD, LABELLERS, SILENT, estimate, signals, vote_digits, votes
from fraudlake.llm.word_grams import LOWER, Hasher, Words, text_parts


def votes_on(texts):
    ((_, _, data, offsets),) = text_parts(pa.array(texts))
    found = votes(signals(data, offsets, Words(LOWER[data], offsets, Hasher())))
    return [dict(zip(LABELLERS, row)) for row in vote_digits(found)]


def test_labellers():
    prose = "The cat sat on a mat, and then it went away again to look for some milk. " * 2
    got = votes_on([prose, prose.upper(), "no no no no no no no", "ab&&& cd%%% ef*** gh### ij", "One", ""])
    assert got[0]["prose"] == GOOD and got[0]["sentences"] == GOOD and BAD not in got[0].values()
    assert got[1]["shouting"] == BAD and GOOD not in got[1].values()
    assert got[2]["stutter"] == BAD and got[2]["prose"] == ABSTAIN and got[2]["few_words"] == SILENT
    assert got[3]["symbols"] == BAD
    assert set(got[4].values()) == set(got[5].values()) == {SILENT}


def test_estimated_accuracies_are_those_of_simulated_labellers():
    rng = np.random.default_rng(0)
    n, verdicts = 60_000, np.array([v for v, _, _ in LABELLERS.values()])
    good = rng.random(n) < 0.7
    own = np.where(verdicts[None] == GOOD, good[:, None], ~good[:, None])
    right, wrong = rng.uniform(0.5, 0.9, len(verdicts)), rng.uniform(0.01, 0.1, len(verdicts))
    cast = rng.random((n, len(verdicts))) < np.where(own, right, wrong)
    digits = np.where(rng.random(cast.shape) < 0.1, SILENT, np.where(cast, verdicts, ABSTAIN))
    patterns, back, counts = np.unique(digits @ 4 ** np.arange(len(verdicts) - 1, -1, -1), return_inverse=True, return_counts=True)
    posterior, accuracy, share = estimate(patterns, counts)
    assert abs(share - 0.7) < 0.02 and ((posterior[back] > 0.5) == good).mean() > 0.97
    true = np.array([own[:, j][digits[:, j] == v].mean() for j, v in enumerate(verdicts)])
    assert np.abs(accuracy - true).max() < 0.02


def test_held_out_accuracy_on_the_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op3_quality(spark, sf_dir).collect()}
    labels = table(spark, sf_dir, "labels").collect()
    assert len(got) == table(spark, sf_dir, "documents").count()
    assert np.mean([got[r.doc_id].keep == bool(r.quality) for r in labels]) > 0.97


def test_hard_rows(spark):
    prose = "It was a long day, and we were all glad to be home again before the rain came down. "
    rows = [(i, f"{prose} Number {i} said so. " * 3) for i in range(60)] + [(100 + i, f"WHAT{i} IS!! THIS!! " * 9) for i in range(20)]
    hard = [(None, prose), (None, prose), (300, None), (301, ""), (302, " %% "), (303, prose * 3000), (1, rows[1][1])]
    docs = spark.createDataFrame(rows + hard, "doc_id long, text string").withColumns({"score": F.lit("x"), "k0": F.lit(1), "pattern": F.lit(2)})
    frame, accuracies = classify(docs, ["doc_id"])
    got = frame.collect()
    assert len(got) == len(rows) + len(hard) and set(accuracies) == set(LABELLERS)
    score = {r.doc_id: r.score for r in got}
    assert score[300] == score[301] == score[302] == 0 and all(0 <= s <= 1 for s in score.values())
    assert all(score[i] > 0.5 for i in range(60)) and all(score[100 + i] < 0.5 for i in range(20)) and score[303] > 0.5
    empty, _ = classify(docs.limit(0), ["doc_id"])
    assert empty.count() == 0
