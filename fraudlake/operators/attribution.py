"""Mean absolute Shapley value per feature of a boosted-tree model (ML-14, REP-06).

The game of one leaf is a product over the features on its path: a known feature contributes 1
or 0 (does the row pass the leaf's interval), an unknown one the share of training rows that
passed. The Shapley value of a product game is an integral of a polynomial over [0, 1], which
Gauss-Legendre nodes evaluate exactly; no subset is enumerated, and leaves share their paths.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fraudlake.operators.split import sample_rows
from fraudlake.operators.trees import Tree, TreeModel

SAMPLE_ROWS = 5000
TOP_FEATURES = 20


def model_leaves(model: TreeModel) -> dict[str, np.ndarray]:
    """The leaves of all trees as flat arrays: value per leaf, and per leaf and feature on its path the
    interval (low, high], whether missing values pass, and the share of training weight that passed.

    Their number is that of the model (trees x leaves), which its parameters bound, not the data.
    """
    values, starts, flat = [], [0], []
    for tree in model.trees:
        stack = [(0, {})]
        while stack:
            node, path_features = stack.pop()
            feature = tree.feature[node]
            if feature < 0:
                values.append(tree.value[node])
                flat.extend((f, *bounds) for f, bounds in path_features.items())
                starts.append(len(flat))
                continue
            threshold, missing_left = tree.threshold[node], tree.missing_left[node]
            low, high, missing, cover = path_features.get(feature, (-np.inf, np.inf, True, 1.0))
            for child, interval, passes in (
                (tree.left[node], (low, min(high, threshold)), missing and missing_left),
                (tree.right[node], (max(low, threshold), high), missing and not missing_left),
            ):
                passed = cover * tree.cover[child] / tree.cover[node]
                stack.append((child, {**path_features, feature: (*interval, passes, passed)}))
    table = np.array(flat, dtype=float).reshape(-1, 5)
    return {
        "value": np.array(values),
        "start": np.array(starts),
        "feature": table[:, 0].astype(int),
        "low": table[:, 1],
        "high": table[:, 2],
        "missing": table[:, 3] == 1,
        "cover": table[:, 4],
    }


def tree_attributions(tree: Tree, x: np.ndarray, phi: np.ndarray, nodes: np.ndarray, weights: np.ndarray) -> None:
    """Adds the attributions of one tree for all rows of ``x`` to ``phi``, in one walk over its nodes.

    Going down, ``product`` [row, point] is that of the path's factors: of each feature on the path
    ``cover + u * gap`` at the points u. Coming back up, ``below`` is the sum of value times product over
    the leaves of a subtree. An edge that narrows a feature gives it ``gap / factor`` of what lies below,
    and takes back what the feature's earlier, wider factor gave it for the same leaves. So leaves
    share the work of their path: the time grows with the number of nodes.
    """

    def walk(node: int, product: np.ndarray, path: dict) -> np.ndarray:
        feature = tree.feature[node]
        if feature < 0:
            return tree.value[node] * product
        own, low = x[:, feature], tree.threshold[node]
        left = np.where(np.isnan(own), tree.missing_left[node], own <= low)
        before = path.get(feature)
        total = 0.0
        for child, goes in ((tree.left[node], left), (tree.right[node], ~left)):
            share = tree.cover[child] / tree.cover[node]
            passed, cover, factor = before or (True, 1.0, 1.0)
            now, part = goes & passed, cover * share
            gap = now - part
            narrower = part + gap[:, None] * nodes
            below = walk(child, product / factor * narrower, {**path, feature: (now, part, narrower)})
            phi[:, feature] += gap * ((below / narrower) @ weights)
            if before:
                phi[:, feature] -= (passed - cover) * ((below / factor) @ weights)
            total = total + below
        return total

    walk(0, np.ones((len(x), len(nodes))), {})


def tree_depth(tree: Tree) -> int:
    """Features on the longest path, counted with repetition."""
    depth = [0] * len(tree.feature)
    for node, feature in enumerate(tree.feature):
        if feature >= 0:
            depth[tree.left[node]] = depth[tree.right[node]] = depth[node] + 1
    return max(depth)


def shapley_rows(
    model: TreeModel,
    df: DataFrame,
    features: Sequence[str],
    row_id: str = "TransactionID",
) -> DataFrame:
    """(id, base, one attribution per feature); base plus attributions is the row's margin."""
    features = list(features)
    leaves = model_leaves(model)
    start, cover = leaves["start"], leaves["cover"]
    base = float(
        sum(v * cover[start[i] : start[i + 1]].prod() for i, v in enumerate(leaves["value"]))
    )
    depth = max((tree_depth(tree) for tree in model.trees), default=0)
    nodes, weights = np.polynomial.legendre.leggauss(depth // 2 + 1)
    nodes, weights = (nodes + 1) / 2, weights / 2
    shared = df.sparkSession.sparkContext.broadcast(model)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch[features].to_numpy(dtype=float)
            phi = np.zeros(x.shape)
            for tree in shared.value.trees:
                if tree.feature[0] >= 0:
                    tree_attributions(tree, x, phi, nodes, weights)
            out = pd.DataFrame(phi, columns=features)
            out.insert(0, row_id, batch[row_id].to_numpy())
            out.insert(1, "base", base)
            yield out

    schema = f"{row_id} long, base double, " + ", ".join(f"`{c}` double" for c in features)
    return df.select(row_id, *[F.col(c).cast("double").alias(c) for c in features]).mapInPandas(explain, schema)


def mean_attribution(
    model: TreeModel,
    df: DataFrame,
    features: Sequence[str],
    row_id: str = "TransactionID",
    sample: int | None = None,
    seed: int = 42,
) -> DataFrame:
    """(feature, mean_abs_shap) over all rows, or a seeded sample of them, largest first."""
    features = list(features)
    rows = df.select(row_id, *features)
    if sample is not None:
        tasks = df.sparkSession.sparkContext.defaultParallelism
        rows = sample_rows(rows, sample, row_id, seed).repartition(tasks, row_id)
    explained = shapley_rows(model, rows, features, row_id)
    means = explained.agg(*[F.avg(F.abs(F.col(c))).alias(c) for c in features])
    return means.unpivot([], features, "feature", "mean_abs_shap").orderBy(
        F.desc("mean_abs_shap"), F.asc("feature")
    )


def top_features(attribution: DataFrame, n: int = TOP_FEATURES) -> DataFrame:
    return attribution.orderBy(F.desc("mean_abs_shap"), F.asc("feature")).limit(n)
