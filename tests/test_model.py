import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from fraudlake.operators import attribution, boosting, evaluate, oversample, running, segment, split
from fraudlake.plans import eda


@pytest.fixture(scope="module")
def planted(spark):
    """600 rows whose label depends on two of three features."""
    rng = np.random.default_rng(3)
    x = rng.uniform(0, 1, (600, 3))
    label = ((x[:, 0] > 0.7) & (x[:, 1] > 0.5)).astype(int)
    rows = [(i, int(label[i]), *map(float, x[i])) for i in range(600)]
    return spark.createDataFrame(rows, "TransactionID long, isFraud long, a double, b double, c double").cache()


@pytest.fixture(scope="module")
def fitted(planted):
    params = {**boosting.DEFAULT_PARAMS, "n_estimators": 6, "max_depth": 3}
    return boosting.fit_boosted_trees(planted, ["a", "b", "c"], params)


def scored(spark, pairs):
    return spark.createDataFrame(
        [(i, y, s) for i, (y, s) in enumerate(pairs)], "TransactionID long, isFraud long, fraud_prob double"
    )


def random_scores(spark, n=800, digits=2):
    rng = np.random.default_rng(11)
    labels = (rng.uniform(size=n) < 0.2).astype(int)
    scores = np.round(np.clip(rng.normal(0.4 + 0.2 * labels, 0.2), 0, 1), digits)
    return labels, scores, scored(spark, [(int(y), float(s)) for y, s in zip(labels, scores)])


def test_running_totals_equal_the_sequential_sum(spark):
    rng = np.random.default_rng(1)
    values = np.unique(np.concatenate([rng.uniform(0, 1e-6, 200), rng.uniform(0, 1e6, 200)]))
    df = spark.createDataFrame([(float(v), int(i)) for i, v in enumerate(values)], "v double, n long")
    for descending in (False, True):
        got = running.running_totals(df, "v", {"total": F.col("n")}, descending).collect()
        order = sorted(got, key=lambda r: r["v"], reverse=descending)
        assert [r["total"] for r in order] == list(np.cumsum([r["n"] for r in order]))


def test_running_totals_of_equal_values_follow_the_ties(spark):
    df = spark.range(50).selectExpr("id AS TransactionID", "CAST(1.5 AS DOUBLE) AS v")
    got = running.running_totals(df, "v", {"position": F.lit(1)}, ties="TransactionID")
    assert {r["TransactionID"]: r["position"] for r in got.collect()} == {i: i + 1 for i in range(50)}


def test_auc_equals_the_evaluator_and_pair_counting(spark):
    labels, scores, df = random_scores(spark)
    positive, negative = scores[labels == 1], scores[labels == 0]
    wins = (positive[:, None] > negative).sum() + 0.5 * (positive[:, None] == negative).sum()
    auc = evaluate.auc_roc(df).first()[0]
    assert auc == pytest.approx(wins / (len(positive) * len(negative)), abs=1e-12)
    evaluator = BinaryClassificationEvaluator(
        rawPredictionCol="fraud_prob", labelCol="isFraud", numBins=0
    )
    assert auc == pytest.approx(evaluator.evaluate(df.withColumn("isFraud", F.col("isFraud").cast("double"))), abs=1e-12)


def test_average_precision_is_the_step_sum(spark):
    labels, scores, df = random_scores(spark)
    total, last, want = labels.sum(), 0.0, 0.0
    for t in sorted(set(scores), reverse=True):
        hit = labels[scores >= t].sum()
        want += (hit / total - last) * hit / (scores >= t).sum()
        last = hit / total
    assert evaluate.average_precision(df).first()[0] == pytest.approx(want, abs=1e-12)


def test_thresholds_equal_a_full_rescan(spark):
    labels, scores, df = random_scores(spark)
    best_f1 = best_cost = None
    for t in sorted(set(scores)):
        flagged = scores >= t
        tp, fp = (flagged & (labels == 1)).sum(), (flagged & (labels == 0)).sum()
        p, r = tp / flagged.sum(), tp / labels.sum()
        f1 = 2 * p * r / (p + r + 1e-9)
        cost = 10 * (labels.sum() - tp) + fp
        if best_f1 is None or f1 > best_f1[0]:
            best_f1 = (f1, t)
        if best_cost is None or cost < best_cost[0]:
            best_cost = (cost, t)
    row = evaluate.threshold_analysis(df).first()
    assert row["f1_optimal_threshold"] == best_f1[1]
    assert row["cost_optimal_threshold"] == best_cost[1]
    assert evaluate.f1_optimal_threshold(df).first()[0] == best_f1[1]
    assert evaluate.cost_optimal_threshold(df).first()[:] == (best_cost[1], best_cost[0])


def test_equal_cost_takes_the_lower_threshold(spark):
    # score >= 0.2: fn 0, fp 10 -> 10; score >= 0.9: fn 1, fp 0 -> 10
    df = scored(spark, [(1, 0.9), (1, 0.2)] + [(0, 0.5)] * 10)
    assert evaluate.cost_optimal_threshold(df).first()[:] == (0.2, 10)


def test_report_and_confusion_agree(spark):
    _, _, df = random_scores(spark)
    row = evaluate.metrics_row(df).first()
    matrix = {r["actual"]: (r["predicted_0"], r["predicted_1"]) for r in evaluate.confusion_matrix(df).collect()}
    assert row["confusion_matrix"] == [list(matrix[0]), list(matrix[1])]
    report = evaluate.classification_report(df).first()
    for name in ("precision_fraud", "recall_fraud", "f1_fraud", "f1_legit", "support_fraud"):
        assert row[name] == report[name]
    assert sum(map(sum, row["confusion_matrix"])) == 800


def test_one_class_gives_null_not_an_error(spark):
    row = evaluate.metrics_row(scored(spark, [(0, 0.1), (0, 0.2)])).first()
    assert row["auc_roc"] is None and row["recall_fraud"] == 0.0


def test_quality_gate_bands(spark):
    for auc, band in ((0.79, "below_0.80"), (0.82, "below_0.85"), (0.86, "below_0.88"), (0.9, None)):
        assert evaluate.quality_gate(spark.createDataFrame([(auc,)], "auc_roc double")).first()[1] == band


def test_tiers_include_both_bounds_and_null(spark):
    df = scored(spark, [(0, 0.29), (0, 0.30), (0, 0.70), (0, 0.71), (0, None)])
    got = {r["fraud_prob"]: (r["risk_label"], r["risk_score"]) for r in segment.with_tier(df).collect()}
    assert got == {
        0.29: ("Low", 1), 0.30: ("Medium", 2), 0.70: ("Medium", 2), 0.71: ("High", 3), None: ("Medium", 2),
    }


def test_split_and_folds_are_exact_per_class(spark, planted):
    sizes = {r["isFraud"]: r["count"] for r in planted.groupBy("isFraud").count().collect()}
    train, test = split.stratified_split(planted)
    got = {r["isFraud"]: r["count"] for r in test.groupBy("isFraud").count().collect()}
    assert got == {c: int(n * 0.2 + 0.5) for c, n in sizes.items()}
    assert train.count() + test.count() == 600 and train.join(test, "TransactionID").count() == 0
    folds = split.with_fold(planted).groupBy("isFraud", "fold").count().collect()
    for c, n in sizes.items():
        counts = [r["count"] for r in folds if r["isFraud"] == c]
        assert sum(counts) == n and len(counts) == 3 and max(counts) - min(counts) <= 1


def test_split_moves_no_rows(spark, planted):
    plan = split.with_test_flag(planted)._jdf.queryExecution().executedPlan().toString()
    # The cut-offs are broadcast by their size; the rows stay where they are.
    assert "Exchange hashpartitioning" not in plan and "Exchange rangepartitioning" not in plan


def test_splits_refine_groups_and_take_any_number_of_classes(spark, monkeypatch):
    monkeypatch.setattr(split, "GROUP_ROWS", 3)
    df = spark.range(20_000).selectExpr("id AS TransactionID", "IF(id < 10000, -1L, id % 1200) AS isFraud")
    sizes = {r[0]: (r[1], r[2]) for r in split.with_test_flag(df).groupBy("isFraud").agg(F.count("*"), F.count_if("is_test")).collect()}
    assert len(sizes) == 1201 and all(test == int(n * 0.2 + 0.5) for n, test in sizes.values())
    folds = split.with_fold(df).groupBy("isFraud", "fold").count().where("isFraud = -1").collect()
    assert sorted(r["count"] for r in folds) == [3333, 3333, 3334]
    assert split.sample_rows(df, 777).count() == 777


def test_tiny_classes_split_and_fold(spark):
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1)], "TransactionID long, isFraud long")
    assert split.with_test_flag(df).where("is_test").count() == 0
    assert split.with_fold(df).count() == 3


def test_sample_is_exact_and_repeatable(spark, planted):
    ids = lambda df: sorted(r[0] for r in df.select("TransactionID").collect())
    first = ids(split.sample_rows(planted, 50))
    assert len(first) == 50 and first == ids(split.sample_rows(planted, 50))
    assert first != ids(split.sample_rows(planted, 50, seed=7))
    assert split.sample_rows(planted, 10_000).count() == 600
    assert split.sample_rows(planted, 0).count() == 0


def test_neighbors_are_exact_in_one_block(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(80, 4))
    points = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "TransactionID long, features array<double>")
    got = oversample.nearest_neighbors(points, 80, dimensions=4, k=3).collect()
    d = ((x[:, None] - x[None]) ** 2).sum(-1)
    np.fill_diagonal(d, np.inf)
    for i in range(80):
        mine = [r["neighbor"] for r in sorted((r for r in got if r["TransactionID"] == i), key=lambda r: r["rank"])]
        assert mine == list(np.argsort(d[i])[:3])


def test_neighbors_in_many_blocks_are_close_and_repeatable(spark, monkeypatch):
    monkeypatch.setattr(oversample, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(c, 0.05, size=(60, 3)) for c in (0, 5, 10, 15)])
    points = spark.createDataFrame([(i, list(map(float, v))) for i, v in enumerate(x)], "TransactionID long, features array<double>")
    run = lambda: sorted(map(tuple, oversample.nearest_neighbors(points, 240, dimensions=3, k=3).collect()))
    got = run()
    assert len({r[:2] for r in got}) == 240 * 3 and all(i != j for i, j, _ in got)
    assert np.mean([i // 60 == j // 60 for i, j, _ in got]) > 0.95
    assert got == run()


@pytest.mark.parametrize("minority", [79, 80, 81, 121, 161])
def test_synthetic_total_is_exact_with_outliers_and_small_last_blocks(spark, monkeypatch, minority):
    monkeypatch.setattr(oversample, "BLOCK_ROWS", 40)
    rng = np.random.default_rng(minority)
    x = rng.normal(size=(minority, 2))
    x[0] = 1e6
    rows = [(i, 1, *map(float, v)) for i, v in enumerate(x)] + [(1000 + i, 0, 0.0, 0.0) for i in range(1500)]
    df = spark.createDataFrame(rows, "TransactionID long, isFraud long, a double, b double")
    got = oversample.synthetic_minority(df, ["a", "b"], ratio=0.5).collect()
    assert len(got) == 750 - minority and {r["base_id"] for r in got} == set(range(minority))


def test_synthetic_rows_lie_between_minority_rows(spark, planted):
    minority = {r["TransactionID"]: np.array(r[2:5]) for r in planted.where("isFraud = 1").collect()}
    majority = 600 - len(minority)
    ratio = 2 * len(minority) / majority
    rows = oversample.synthetic_minority(planted, ["a", "b", "c"], ratio=ratio).collect()
    assert len(rows) == int(ratio * majority) - len(minority)
    for r in rows:
        low, high = minority[r["base_id"]], minority[r["neighbor_id"]]
        point = np.array([r["a"], r["b"], r["c"]])
        step = (point - low) / np.where(high == low, 1, high - low)
        assert np.allclose(step, step[0], atol=1e-6) and -1e-9 <= step[0] <= 1
    total = oversample.oversample(planted, ["a", "b", "c"], ratio=ratio)
    assert total.where("isFraud = 1").count() == int(ratio * majority)
    assert oversample.synthetic_minority(planted, ["a"], ratio=0.01) is None


def test_model_finds_the_planted_signal_and_repeats(spark, planted, fitted):
    predictions = boosting.score(fitted, planted)
    auc = evaluate.auc_roc(predictions).first()[0]
    assert auc > 0.95
    params = {**boosting.DEFAULT_PARAMS, "n_estimators": 6, "max_depth": 3}
    again = boosting.score(boosting.fit_boosted_trees(planted, ["a", "b", "c"], params), planted)
    assert evaluate.auc_roc(again).first()[0] == auc
    row = predictions.first()
    assert row["predicted_label"] == int(row["fraud_prob"] >= 0.5)


def test_attributions_add_up_to_the_margin(spark, planted, fitted):
    explained = attribution.shapley_rows(fitted, planted, ["a", "b", "c"])
    joined = explained.join(boosting.score(fitted, planted), "TransactionID").toPandas()
    total = joined["base"] + joined["a"] + joined["b"] + joined["c"]
    probability = 1 / (1 + np.exp(-total))
    assert np.abs(probability - joined["fraud_prob"]).max() < 1e-9
    ranked = [r["feature"] for r in attribution.mean_attribution(fitted, planted, ["a", "b", "c"], sample=100).collect()]
    assert set(ranked[:2]) == {"a", "b"}


def test_attribution_equals_subset_enumeration(spark, planted, fitted):
    from itertools import combinations
    from math import factorial

    leaves = attribution.model_leaves(fitted)
    row = planted.where("TransactionID = 17").first()
    x = [row["a"], row["b"], row["c"]]

    def value(known):
        total = 0.0
        for i, v in enumerate(leaves["value"]):
            part = slice(leaves["start"][i], leaves["start"][i + 1])
            for f, low, high, cover in zip(*(leaves[k][part] for k in ("feature", "low", "high", "cover"))):
                v *= (low < x[f] <= high) if f in known else cover
            total += v
        return total

    got = attribution.shapley_rows(fitted, planted.where("TransactionID = 17"), ["a", "b", "c"]).first()
    for f in range(3):
        others = [g for g in range(3) if g != f]
        want = sum(
            factorial(k) * factorial(2 - k) / 6 * (value({*s, f}) - value(set(s)))
            for k in range(3)
            for s in combinations(others, k)
        )
        assert got["abc"[f]] == pytest.approx(want, abs=1e-9)


def test_search_scores_every_candidate(spark, planted):
    candidates = [
        {**boosting.DEFAULT_PARAMS, "n_estimators": 1, "max_depth": 1},
        {**boosting.DEFAULT_PARAMS, "n_estimators": 3, "max_depth": 3},
    ]
    trials = boosting.search(planted, ["a", "b", "c"], candidates, folds=2, parallelism=2, use_smote=True)
    assert [t["number"] for t in trials] == [0, 1] and all(0.5 < t["value"] <= 1 for t in trials)
    assert boosting.best_params(trials)["max_depth"] == 3
    assert boosting.draw_params(3) == boosting.draw_params(3)
    for params in boosting.draw_params(20):
        for name, (low, high, _) in boosting.SEARCH_SPACE.items():
            assert low <= params[name] <= high


def test_matrix_keeps_numbers_and_marks_missing(spark):
    df = spark.createDataFrame(
        [(1, 0, None, "x", 2)], "TransactionID long, isFraud long, D1 double, card4_amt_bucket string, n int"
    )
    matrix, features = boosting.feature_matrix(df)
    assert features == ["D1", "n"] and matrix.first()[:] == (1, 0, boosting.MISSING_VALUE, 2.0)
    low = spark.createDataFrame([(1, 0, -5e6), (2, 0, None)], "TransactionID long, isFraud long, D1 double")
    values = {r[0]: r[2] for r in boosting.feature_matrix(low)[0].collect()}
    assert values[2] < values[1] == -5e6


def test_constant_column_has_no_correlation(spark):
    df = spark.createDataFrame([(0, 1.0, 2.0), (1, 1.0, 4.0), (1, 1.0, None)], "isFraud long, k double, x double")
    got = {r[0]: r[1] for r in eda.label_correlation(df, ["k", "x"]).collect()}
    assert got["k"] is None and got["x"] == pytest.approx(1.0)


def test_neighbors_above_one_block_are_those_of_brute_force(spark):
    rng = np.random.default_rng(8)
    x = np.concatenate((rng.normal(size=(4500, 4)), rng.normal(size=(300, 4)) * 1e-3, np.zeros((200, 4))))
    points = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "TransactionID long, features array<double>")
    got = np.full((len(x), 5), -1)
    for r in oversample.nearest_neighbors(points, len(x), dimensions=4).collect():
        got[r.TransactionID, r["rank"] - 1] = r.neighbor
    assert (got >= 0).all() and not (got == np.arange(len(x))[:, None]).any()
    squares = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    np.fill_diagonal(squares, np.inf)
    assert np.allclose(np.take_along_axis(squares, got, axis=1), np.sort(squares, axis=1)[:, :5], rtol=1e-9, atol=0)


def test_neighbors_of_many_independent_features_take_few_distances(spark):
    rng = np.random.default_rng(30)
    x = rng.normal(size=(20_000, 30)) * rng.uniform(0.5, 2, 30)
    frame = pd.DataFrame({"TransactionID": np.arange(len(x)), "features": x.tolist()})
    points = spark.createDataFrame(frame, "TransactionID long, features array<double>")
    got = np.full((len(x), 5), -1)
    found = oversample.neighbor_distances(points, len(x), dimensions=30).toPandas()
    got[found["TransactionID"], found["rank"] - 1] = found["neighbor"]
    lengths = (x * x).sum(axis=1)
    for a in range(0, len(x), 1000):
        squares = lengths[a : a + 1000, None] + lengths[None] - 2 * x[a : a + 1000] @ x.T
        squares[np.arange(1000), np.arange(a, a + 1000)] = np.inf
        assert (np.argsort(squares, axis=1)[:, :5] == got[a : a + 1000]).all()
    # Distances that a block of points takes of all the others, nothing known before.
    ids = np.arange(len(x))
    taken = sum(
        oversample.nearest_pairs(ids[:2048], x[:2048], ids[b : b + 2048], x[b : b + 2048], 5)[1]
        for b in range(0, len(x), 2048)
    )
    assert taken < 0.01 * 2048 * len(x)


@pytest.mark.parametrize("odd", [None, float("nan"), float("inf"), 1e200])
def test_neighbors_with_a_value_that_has_no_distance(spark, monkeypatch, odd):
    monkeypatch.setattr(oversample, "BLOCK_ROWS", 40)
    x = np.random.default_rng(5).normal(size=(200, 2)).tolist()
    x[3][0] = odd
    points = spark.createDataFrame(list(enumerate(x)), "TransactionID long, features array<double>")
    found = oversample.neighbor_distances(points, 200, dimensions=2, k=3).where("TransactionID <> 3").toPandas()
    known = np.array([v for i, v in enumerate(x) if i != 3])
    squares = ((known[:, None] - known[None]) ** 2).sum(axis=2)
    np.fill_diagonal(squares, np.inf)
    want = np.sort(squares, axis=1)[:, :3].ravel()
    assert np.allclose(found.sort_values(["TransactionID", "rank"])["distance"], want, rtol=1e-9, atol=0)


def test_repeated_points_are_not_paired_with_all_their_copies(spark, monkeypatch):
    monkeypatch.setattr(oversample, "BLOCK_ROWS", 40)
    x = [[1.0, 2.0]] * 150 + np.random.default_rng(6).normal(size=(150, 2)).tolist()
    points = spark.createDataFrame(list(enumerate(x)), "TransactionID long, features array<double>")
    found = oversample.neighbor_distances(points, 300, dimensions=2, k=5).toPandas()
    assert (found.groupby("TransactionID").size() == 5).all()
    assert (found[found["TransactionID"] < 150]["distance"] == 0).all()
