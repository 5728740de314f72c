import numpy as np
import pytest
from pyspark.sql import functions as F

from fraudlake.operators import attribution, boosting, evaluate, trees
from fraudlake.operators.trees import BINS, Booster, Tree

PARAMS = {**boosting.DEFAULT_PARAMS, "subsample": 1.0, "colsample_bytree": 1.0}
UNIT = float(1 << trees.SCALE_BITS)


def soft(g, a):
    return max(abs(g) - a, 0) * (1 if g > 0 else -1)


def plain_tree(x, y, w, margin, cuts, params):
    """One tree by loops over all features, cut points and both sides for missing rows."""
    p = 1 / (1 + np.exp(-margin))
    g, h = np.rint(w * (p - y) * UNIT) / UNIT, np.rint(w * p * (1 - p) * UNIT) / UNIT
    lam, alpha = params["reg_lambda"], params["reg_alpha"]
    s = lambda rows: soft(g[rows].sum(), alpha) ** 2 / (h[rows].sum() + lam)
    splits, values = [], np.zeros(len(y))

    def grow(rows, depth):
        best = None
        if depth < params["max_depth"]:
            for f in range(x.shape[1]):
                own, gone = x[rows, f], np.isnan(x[rows, f])
                for limit in [*cuts[f], np.inf]:
                    for missing_left in (False, True):
                        left = np.where(gone, missing_left, own <= limit)
                        a, b = rows[left], rows[~left]
                        if min(h[a].sum(), h[b].sum()) < max(params["min_child_weight"], trees.LEAST_GAIN):
                            continue
                        gain = s(a) + s(b) - s(rows)
                        if best is None or gain > best[0] + 1e-12:
                            best = (gain, f, limit, missing_left, a, b)
        if best is None or best[0] <= trees.LEAST_GAIN or best[0] < params["gamma"]:
            values[rows] = -params["learning_rate"] * soft(g[rows].sum(), alpha) / (h[rows].sum() + lam)
            return
        splits.append((best[1], best[2], best[3], round(best[0], 6)))
        grow(best[4], depth + 1)
        grow(best[5], depth + 1)

    grow(np.arange(len(y)), 0)
    return sorted(splits), values


def table(spark, n=300, seed=0, missing=0.2):
    rng = np.random.default_rng(seed)
    x = np.round(rng.uniform(0, 1, (n, 4)), 2)
    y = ((x[:, 0] > 0.7) & (x[:, 1] > 0.4) | (x[:, 2] > 0.9)).astype(int)
    gone = rng.uniform(size=n) < missing
    x[gone & (x[:, 0] > 0.5), 0] = np.nan  # missing rows are like those with large values
    rows = [(i, int(y[i]), *[None if np.isnan(v) else float(v) for v in x[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, "TransactionID long, isFraud long, a double, b double, c double, d double")
    return df.repartition(3), x, y


NAMES = ["a", "b", "c", "d"]


@pytest.mark.parametrize("change", [{}, {"reg_alpha": 3.0, "reg_lambda": 0.5, "gamma": 2.0, "max_depth": 4}, {"min_child_weight": 20}])
def test_trees_equal_a_plain_version(spark, change):
    df, x, y = table(spark)
    params = {**PARAMS, "n_estimators": 2, "max_depth": 3, **change}
    model = boosting.fit_boosted_trees(df, NAMES, params)
    cuts = trees.cut_points(df, NAMES)
    w = np.where(y == 1, boosting.with_class_weight(df).agg(F.max("class_weight")).first()[0], 1.0)
    margin = np.zeros(len(y))
    for tree in model.trees:
        want, values = plain_tree(x, y, w, margin, cuts, params)
        inner = [i for i, f in enumerate(tree.feature) if f >= 0]
        got = sorted((tree.feature[i], tree.threshold[i], tree.missing_left[i], round(tree.gain[i], 6)) for i in inner)
        assert got == want and want
        assert np.allclose(np.array(tree.value)[tree.leaves_of_values(x)], values, atol=1e-12)
        margin += values
    assert np.allclose(model.margins(x), margin, atol=1e-12)


def test_missing_rows_learn_their_side(spark):
    df, x, y = table(spark, missing=1.0)
    tree = boosting.fit_boosted_trees(df, NAMES, {**PARAMS, "n_estimators": 1, "max_depth": 2}).trees[0]
    roots = [i for i, f in enumerate(tree.feature) if f == 0]
    assert roots and not any(tree.missing_left[i] for i in roots)


def test_trees_do_not_depend_on_how_rows_are_dealt(spark):
    df, _, _ = table(spark, 500)
    params = {**PARAMS, "n_estimators": 3, "subsample": 0.7, "colsample_bytree": 0.6}
    models = [boosting.fit_boosted_trees(df.repartition(n), NAMES, params) for n in (1, 5)]
    assert models[0].trees == models[1].trees


def test_small_histograms_change_nothing(spark, monkeypatch):
    df, _, _ = table(spark, 400)
    params = {**PARAMS, "n_estimators": 1, "max_depth": 5, "min_child_weight": 0}
    whole = boosting.fit_boosted_trees(df, NAMES, params)
    monkeypatch.setattr(trees, "HISTOGRAM_BYTES", 2 * 4 * (BINS + 1) * 16)
    assert boosting.fit_boosted_trees(df, NAMES, params).trees == whole.trees


def test_prefix_auc_and_early_stopping_equal_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(trees, "ROUNDS", 4)
    df, x, y = table(spark, 400, 3)
    df = df.withColumn("held", F.col("TransactionID") % 3 == 0)
    params = {**PARAMS, "n_estimators": 14, "max_depth": 2, "learning_rate": 0.6}
    fit = boosting.booster(df, NAMES, params, validation_flag="held", patience=3)
    fit.advance(14)
    held = np.arange(400) % 3 == 0
    margin, aucs = np.zeros(400), []
    for tree in fit.trees:
        margin = margin + np.array(tree.value)[tree.leaves_of_values(x)]
        s = np.floor(trees.SCORE_STEPS / (1 + np.exp(-margin)))
        a, b = s[held & (y == 1)], s[held & (y == 0)]
        aucs.append(((a[:, None] > b).sum() + 0.5 * (a[:, None] == b).sum()) / (len(a) * len(b)))
    assert fit.aucs == pytest.approx(aucs, abs=1e-12)
    best, stop = 0, None
    for i, auc in enumerate(aucs):
        if auc > aucs[best]:
            best = i
        elif i - best >= 3:
            stop = i
            break
    assert len(fit.model().trees) == best + 1
    assert stop is None or len(fit.trees) < stop + 1 + 4


def test_stopping_looks_only_as_far_as_patience_goes():
    fit = Booster(None, [], [], PARAMS, 1, True, patience=2)
    fit.aucs = [0.5, 0.7, 0.6, 0.6, 0.9]
    assert fit.stop_round() == 1
    fit.aucs = [0.5, 0.5, 0.6, 0.6, 0.7]
    assert fit.stop_round() == 4
    fit.aucs = [None, None]
    assert fit.stop_round() == 0


def test_one_class_no_rows_and_no_validation_rows(spark):
    df, _, _ = table(spark, 60)
    one = df.withColumn("isFraud", F.lit(0))
    assert boosting.fit_boosted_trees(one, NAMES, {**PARAMS, "n_estimators": 2}).trees[0].feature == [-1]
    empty = boosting.fit_boosted_trees(df.limit(0), NAMES, {**PARAMS, "n_estimators": 1})
    assert len(empty.trees) == 1 and boosting.score(empty, df).where("fraud_prob = 0.5").count() == 60
    flagged = df.withColumn("held", F.lit(False))
    assert len(boosting.fit_boosted_trees(flagged, NAMES, {**PARAMS, "n_estimators": 2}, validation_flag="held").trees) >= 1


def test_search_halves_and_continues(spark):
    df, _, _ = table(spark, 300, 5)
    drawn = [{**PARAMS, "n_estimators": 8, "max_depth": d, "learning_rate": r} for d, r in ((1, 0.01), (3, 0.3), (2, 0.2), (1, 0.02))]
    trials = boosting.search(df, NAMES, drawn, folds=2)
    assert sorted(t["state"] for t in trials) == ["COMPLETE", "PRUNED", "PRUNED", "PRUNED"]
    best = boosting.best_params(trials)
    assert best["max_depth"] in (2, 3) and all(0 < t["value"] <= 1 for t in trials)
    space = boosting.SEARCH_SPACE
    assert len(space) == 9
    for params in boosting.draw_params(20):
        assert params.keys() == space.keys() and all(low <= params[k] <= high for k, (low, high, _) in space.items())


def test_model_is_saved_and_read_again(spark, tmp_path):
    df, _, _ = table(spark)
    model = boosting.fit_boosted_trees(df, NAMES, {**PARAMS, "n_estimators": 2})
    boosting.save_model(spark, model, str(tmp_path / "m"))
    saved = spark.read.parquet(str(tmp_path / "m" / "nodes"))
    assert saved.count() == sum(len(t.feature) for t in model.trees)
    again = boosting.load_model(spark, str(tmp_path / "m"))
    assert again.trees == model.trees and again.features == model.features and again.params == model.params
    x = np.array([[r[c] if r[c] is not None else np.nan for c in NAMES] for r in df.select(*NAMES).collect()], float)
    assert np.array_equal(again.margins(x), model.margins(x))
    assert evaluate.auc_roc(boosting.score(model, df)).first()[0] > 0.95


def test_empty_tree_has_one_leaf():
    assert Tree().leaves_of_values(np.zeros((3, 2))).tolist() == [0, 0, 0]


def leaf_by_leaf(model, x):
    """Attributions leaf by leaf, each with its own product."""
    leaves = attribution.model_leaves(model)
    u, w = np.polynomial.legendre.leggauss(8)
    u, w = (u + 1) / 2, w / 2
    phi = np.zeros(x.shape)
    for i, value in enumerate(leaves["value"]):
        part = slice(leaves["start"][i], leaves["start"][i + 1])
        columns, cover = leaves["feature"][part], leaves["cover"][part]
        known = x[:, columns]
        passed = (known > leaves["low"][part]) & (known <= leaves["high"][part]) | np.isnan(known) & leaves["missing"][part]
        for r in range(len(x)):
            factors = cover[:, None] + (passed[r] - cover)[:, None] * u
            for j, c in enumerate(columns):
                phi[r, c] += value * (passed[r, j] - cover[j]) * (np.delete(factors, j, axis=0).prod(axis=0) @ w)
    return phi


def test_shared_paths_give_the_attributions_of_every_leaf(spark):
    df, x, _ = table(spark, 600, 7)
    df = df.withColumn("isFraud", F.when(F.col("TransactionID") % 5 == 0, 1 - F.col("isFraud")).otherwise(F.col("isFraud")))
    model = boosting.fit_boosted_trees(df, NAMES, {**PARAMS, "n_estimators": 3, "max_depth": 6, "min_child_weight": 0})
    rows = attribution.shapley_rows(model, df, NAMES).orderBy("TransactionID").toPandas()
    assert max(len(t.feature) for t in model.trees) > 20
    assert np.allclose(rows[NAMES].to_numpy(), leaf_by_leaf(model, x), atol=1e-9)
    assert np.allclose(rows["base"] + rows[NAMES].sum(axis=1), model.margins(x), atol=1e-9)


def test_attribution_time_grows_with_the_nodes(monkeypatch):
    steps = []
    tree = trees.Tree()
    level = [0]
    for depth in range(9):
        level = [c for node in level for c in tree.grow(node, depth % 3, 5, depth / 9, False, 1.0)]
    tree.cover = [2.0 ** -d for d in range(10) for _ in range(2**d)][: len(tree.feature)]
    for node in range(len(tree.feature)):
        if tree.feature[node] >= 0:
            for child in (tree.left[node], tree.right[node]):
                tree.cover[child] = tree.cover[node] / 2
    real = np.where
    monkeypatch.setattr(np, "where", lambda *a: (steps.append(1), real(*a))[1])
    phi = np.zeros((4, 3))
    attribution.tree_attributions(tree, np.zeros((4, 3)), phi, np.array([0.5]), np.array([1.0]))
    assert len(steps) == sum(f >= 0 for f in tree.feature) == 511
