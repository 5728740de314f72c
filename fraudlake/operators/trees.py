"""Second-order boosted trees whose histograms Spark sums (ML-01, ML-07, ML-08).

Rows are packed into blocks of binned features. For every level of a tree, tasks add the gradients and
Hessians of their rows by (node, feature, bin), the sums of all tasks meet by feature, and each node takes
its best split. Gradients are whole multiples of 2^-SCALE_BITS, so that the sums, and with them the trees,
do not depend on how rows are dealt to tasks or in which order sums are taken.

A split's gain is S(left) + S(right) - S(node), where S = T(G)^2 / (H + reg_lambda) and T moves the sum of
gradients by reg_alpha towards zero; it must exceed ``gamma``. Rows that miss the feature have a bin of
their own, and every split is tried with them on either side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.operators.running import running_totals
from fraudlake.session import materialize, release_copy

BINS = 128
SCALE_BITS = 24
HISTOGRAM_BYTES = 1 << 26  # of the sums that one task holds
CUT_CHUNK = 40  # columns whose cut points are found in one scan
ROUNDS = 20  # trees between two copies of the margins
PATIENCE = 50
SCORE_STEPS = 1 << 32  # scores are ranked by their first 32 binary digits
LEAST_GAIN = 1e-6

BLOCK = ["bins", "label", "weight", "valid", "key", "margin"]
BLOCK_SQL = "rows long, " + ", ".join(f"{n} binary" for n in BLOCK)
KINDS = {"bins": np.uint8, "label": np.uint8, "weight": np.float64, "valid": np.uint8, "key": np.uint64, "margin": np.float64}
SPLIT_SQL = (
    "node int, gain double, feature int, bin int, left boolean, "
    "g_left long, h_left long, g long, h long"
)


@dataclass
class Tree:
    """Nodes as parallel lists; ``feature`` is -1 in a leaf. Rows with value <= threshold go left."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    threshold: list[float] = field(default_factory=lambda: [0.0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    cover: list[float] = field(default_factory=lambda: [0.0])

    def grow(self, node: int, feature: int, at: int, threshold: float, missing_left: bool, gain: float) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.threshold[node] = feature, at, threshold
        self.missing_left[node], self.gain[node] = missing_left, gain
        self.left[node], self.right[node] = len(self.feature), len(self.feature) + 1
        for _ in range(2):
            for name, value in vars(Tree()).items():
                getattr(self, name).extend(value)
        return self.left[node], self.right[node]

    def leaves(self, rows: int, goes_left) -> np.ndarray:
        """The leaf of every row; ``goes_left(features, nodes)`` says which rows go left."""
        feature, left, right = (np.array(a) for a in (self.feature, self.left, self.right))
        node = np.zeros(rows, np.int64)
        while (feature[node] >= 0).any():
            at = feature[node]
            node = np.where(at < 0, node, np.where(goes_left(np.maximum(at, 0), node), left[node], right[node]))
        return node

    def leaves_of_bins(self, bins: np.ndarray) -> np.ndarray:
        missing_left, limit = np.array(self.missing_left), np.array(self.bin)
        rows = np.arange(bins.shape[1])

        def goes_left(feature, node):
            own = bins[feature, rows]
            return np.where(own == BINS, missing_left[node], own <= limit[node])

        return self.leaves(len(rows), goes_left)

    def leaves_of_values(self, x: np.ndarray) -> np.ndarray:
        missing_left, limit = np.array(self.missing_left), np.array(self.threshold)
        rows = np.arange(len(x))

        def goes_left(feature, node):
            own = x[rows, feature]
            return np.where(np.isnan(own), missing_left[node], own <= limit[node])

        return self.leaves(len(rows), goes_left)


@dataclass
class TreeModel:
    features: list[str]
    trees: list[Tree]
    params: dict[str, float]

    def margins(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for tree in self.trees:
            total += np.array(tree.value)[tree.leaves_of_values(x)]
        return total


def cut_points(df: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """At most BINS - 1 ascending cut points of every feature, at its approximate quantiles.

    A value belongs to the first bin whose cut point is not below it, the largest ones to the last
    bin. ``percentile_approx`` merges bounded summaries; a scan takes CUT_CHUNK columns.
    """
    shares = F.array(*[F.lit(i / BINS) for i in range(1, BINS)])
    found = []
    for start in range(0, len(features), CUT_CHUNK):
        part = features[start : start + CUT_CHUNK]
        row = df.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), shares, 20 * BINS).alias(c) for c in part]).first()
        found += [sorted(set(row[c] or [])) for c in part]
    return found


def blocks_of(rows: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]]) -> DataFrame:
    """Rows with ``label``, ``weight``, ``valid``, ``key`` and the features as packed blocks, one a batch."""
    names = [f"f{i}" for i in range(len(features))]
    limits = [np.array(c) for c in cuts]
    narrow = rows.select(
        F.col("label").cast("tinyint"), F.col("weight").cast("double"), F.col("valid").cast("tinyint"), F.col("key").cast("long"),
        *(F.col(c).cast("double").alias(n) for c, n in zip(features, names)),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            bins = np.full((len(names), n), BINS, np.uint8)
            for i, (name, limit) in enumerate(zip(names, limits)):
                x = batch.column(name).to_numpy(zero_copy_only=False).astype(np.float64)
                known = ~np.isnan(x)
                bins[i, known] = np.searchsorted(limit, x[known], "left")
            own = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "weight", "valid", "key")}
            arrays = [bins, own["label"], own["weight"], own["valid"], own["key"].astype(np.int64).view(np.uint64), np.zeros(n)]
            packed = [pa.array([a.astype(KINDS[c]).tobytes()], pa.binary()) for c, a in zip(BLOCK, arrays)]
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), *packed], names=["rows", *BLOCK])

    return narrow.mapInArrow(run, BLOCK_SQL)


def unpacked(batch: pa.RecordBatch, trees: Sequence[Tree]) -> Iterator[dict[str, np.ndarray]]:
    """The arrays of each block, with the margins that ``trees`` add to the written ones."""
    for i in range(len(batch)):
        own = {c: np.frombuffer(batch.column(c)[i].as_py(), KINDS[c]) for c in BLOCK}
        own["bins"] = own["bins"].reshape(-1, len(own["label"])) if len(own["label"]) else own["bins"].reshape(0, 0)
        own["margin"] = own["margin"].copy()
        for tree in trees:
            own["margin"] += np.array(tree.value)[tree.leaves_of_bins(own["bins"])]
        yield own


def gradients(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivatives of the weighted log loss, in whole units of 2^-SCALE_BITS."""
    p = 1 / (1 + np.exp(-margin))
    unit = float(1 << SCALE_BITS)
    return np.rint(weight * (p - label) * unit), np.rint(weight * p * (1 - p) * unit)


def drawn(key: np.ndarray, share: float, seed: int) -> np.ndarray:
    """Which rows a tree is fitted on: those whose mixed key is below the share."""
    if share >= 1:
        return np.ones(len(key), bool)
    h = (key ^ np.uint64(seed * 0x9E3779B97F4A7C15 % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
    return (h ^ h >> np.uint64(29)) < np.uint64(int(share * (1 << 64)))


def soft(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def strength(g: np.ndarray, h: np.ndarray, params: dict) -> np.ndarray:
    bottom = h + params["reg_lambda"]
    return np.divide(soft(g, params["reg_alpha"]) ** 2, bottom, out=np.zeros_like(bottom), where=bottom > 0)


def best_splits(sums: np.ndarray, params: dict) -> tuple[np.ndarray, ...]:
    """Per node the best split of a feature, given whole sums ``[node, bin, (g, h)]`` of BINS + 1 bins.

    ``(gain, bin, missing_left, g_left, h_left, g, h)``. The first of equal gains is taken, in the order of
    the bins, with missing rows on the right before those on the left.
    """
    total = sums.sum(axis=1)
    upto = np.cumsum(sums[:, :BINS], axis=1)
    left = np.stack((upto, upto + sums[:, BINS:]), axis=2)  # node, bin, side of the missing, (g, h)
    right = total[:, None, None] - left
    unit = float(1 << SCALE_BITS)
    g, h, gl, hl, gr, hr = (a / unit for a in (total[:, 0], total[:, 1], left[..., 0], left[..., 1], right[..., 0], right[..., 1]))
    gain = strength(gl, hl, params) + strength(gr, hr, params) - strength(g, h, params)[:, None, None]
    least = max(params["min_child_weight"], LEAST_GAIN)
    gain = np.where((hl >= least) & (hr >= least), gain, -np.inf).reshape(len(sums), -1)
    place = gain.argmax(axis=1)
    nodes = np.arange(len(sums))
    chosen = left.reshape(len(sums), -1, 2)[nodes, place]
    return gain[nodes, place], place // 2, place % 2 == 1, chosen[:, 0], chosen[:, 1], total[:, 0], total[:, 1]


def level_splits(blocks: DataFrame, trees: Sequence[Tree], tree: Tree, nodes: Sequence[int], columns: Sequence[int], params: dict, seed: int) -> dict[int, dict]:
    """The best split of each of ``nodes`` of the unfinished ``tree`` over ``columns``, by node."""
    each = max(1, HISTOGRAM_BYTES // (len(columns) * (BINS + 1) * 16))
    found: dict[int, dict] = {}
    for at in range(0, len(nodes), each):
        some = list(nodes[at : at + each])
        found.update(_chunk_splits(blocks, list(trees), tree, some, list(columns), params, seed))
    return found


def _chunk_splits(blocks, trees, tree, nodes, columns, params, seed) -> dict[int, dict]:
    cells = BINS + 1

    def histograms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(len(tree.feature), -1)
        place[nodes] = np.arange(len(nodes))
        sums = np.zeros((len(columns), len(nodes) * cells, 2), np.int64)
        for batch in batches:
            for own in unpacked(batch, trees):
                at = place[tree.leaves_of_bins(own["bins"])]
                used = np.flatnonzero((at >= 0) & (own["valid"] == 0) & drawn(own["key"], params["subsample"], seed))
                g, h = gradients(own["margin"][used], own["label"][used], own["weight"][used])
                first = at[used] * cells
                for i, c in enumerate(columns):
                    cell = first + own["bins"][c, used]
                    # Whole numbers below 2^53 in sum: exact.
                    for j, w in enumerate((g, h)):
                        sums[i, :, j] += np.bincount(cell, w, minlength=sums.shape[1]).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns, pa.int32()), pa.array([s.tobytes() for s in sums], pa.binary())], names=["feature", "sums"]
        )

    def split(parts: pa.Table) -> pa.Table:
        total = np.zeros(len(nodes) * cells * 2, np.int64)
        for raw in parts["sums"]:
            total += np.frombuffer(raw.as_py(), np.int64)
        gain, at, left, gl, hl, g, h = best_splits(total.reshape(len(nodes), cells, 2), params)
        feature = np.full(len(nodes), parts["feature"][0].as_py())
        kinds = [pa.int32(), pa.float64(), pa.int32(), pa.int32(), pa.bool_(), *[pa.int64()] * 4]
        arrays = [np.array(nodes), gain, feature, at, left, gl, hl, g, h]
        return pa.table([pa.array(a, k) for a, k in zip(arrays, kinds)], names=[f.split()[0] for f in SPLIT_SQL.split(", ")])

    # One row per node and feature, whatever the number of rows: the nodes are chosen on the driver.
    splits = blocks.mapInArrow(histograms, "feature int, sums binary").groupBy("feature").applyInArrow(split, SPLIT_SQL)
    found: dict[int, dict] = {}
    for s in sorted(splits.toArrow().to_pylist(), key=lambda s: (-s["gain"], s["feature"])):
        found.setdefault(s["node"], s)
    return found


def grown_tree(blocks: DataFrame, trees: Sequence[Tree], cuts: Sequence[Sequence[float]], params: dict, seed: int) -> Tree:
    """One more tree, level by level; its leaves have their values times the learning rate."""
    rng = np.random.default_rng(seed)
    count = max(1, int(round(params["colsample_bytree"] * len(cuts))))
    columns = sorted(rng.choice(len(cuts), count, replace=False).tolist())
    tree, open_ = Tree(), [0]
    unit = float(1 << SCALE_BITS)

    def settle(node: int, g: int, h: int) -> None:
        bottom = h / unit + params["reg_lambda"]
        tree.cover[node] = h / unit
        tree.value[node] = float(-params["learning_rate"] * soft(np.float64(g / unit), params["reg_alpha"]) / bottom) if bottom > 0 else 0.0

    for _ in range(int(params["max_depth"])):
        splits = level_splits(blocks, trees, tree, open_, columns, params, seed)
        following = []
        for node in open_:
            s = splits[node]
            if node == 0:
                settle(0, s["g"], s["h"])
            limits = cuts[s["feature"]]
            if not (s["gain"] > LEAST_GAIN and s["gain"] >= params["gamma"]):
                continue
            threshold = limits[s["bin"]] if s["bin"] < len(limits) else float("inf")
            left, right = tree.grow(node, s["feature"], s["bin"], threshold, s["left"], s["gain"])
            settle(left, s["g_left"], s["h_left"])
            settle(right, s["g"] - s["g_left"], s["h"] - s["h_left"])
            following += [left, right]
        open_ = following
        if not open_:
            break
    return tree


def prefix_auc(blocks: DataFrame, trees: Sequence[Tree]) -> list[float | None]:
    """The AUC of the validation rows after each of ``trees``, on top of the written margins.

    One aggregation counts the rows by (prefix, score); running totals over all prefixes at once give the
    ranks. None if one class is absent.
    """
    trees = list(trees)

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in unpacked(batch, []):
                held = own["valid"] == 1
                margin, label, bins = own["margin"][held], own["label"][held], own["bins"][:, held]
                for i, tree in enumerate(trees):
                    margin = margin + np.array(tree.value)[tree.leaves_of_bins(bins)]
                    rank = np.minimum(SCORE_STEPS - 1, np.floor(SCORE_STEPS / (1 + np.exp(-margin)))).astype(np.int64)
                    keys, of = np.unique(rank, return_inverse=True)
                    positive = np.bincount(of, label, minlength=len(keys)).astype(np.int64)
                    rows = np.bincount(of, minlength=len(keys)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(i * SCORE_STEPS + keys), pa.array(positive), pa.array(rows - positive)], names=["at", "positive", "negative"]
                    )

    counts = blocks.mapInArrow(scores, "at long, positive long, negative long").groupBy("at")
    counts = counts.agg(F.sum("positive").alias("positive"), F.sum("negative").alias("negative"))
    ranked = running_totals(counts, "at", {"upto": F.col("negative")})
    wins = F.col("positive") * (2 * F.col("upto") - F.col("negative"))
    of = ranked.withColumn("prefix", F.floor(F.col("at") / F.lit(SCORE_STEPS)))
    rows = of.groupBy("prefix").agg(
        F.sum(wins.cast("decimal(38,0)")).alias("wins"), F.sum("positive").alias("p"), F.sum("negative").alias("n")
    ).collect()
    found: list[float | None] = [None] * len(trees)
    for r in rows:
        if r["p"] and r["n"]:
            # The totals before a prefix are those of the prefixes before it.
            own = int(r["wins"]) - 2 * r["p"] * r["n"] * r["prefix"]
            found[r["prefix"]] = own / (2 * r["p"] * r["n"])
    return found


class Booster:
    """Fitting that can be continued: the trees so far, the blocks with their margins, the best round."""

    def __init__(self, blocks: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]], params: dict, seed: int, validated: bool, patience: int = PATIENCE):
        self.blocks, self.features, self.cuts = blocks, list(features), cuts
        self.params, self.seed, self.validated, self.patience = params, seed, validated, patience
        self.trees: list[Tree] = []
        self.written = 0  # trees that the margins of the blocks contain
        self.own_copy: DataFrame | None = None
        self.aucs: list[float | None] = []
        self.stopped = False

    def advance(self, rounds: int) -> None:
        """More trees, until ``rounds`` in all or until PATIENCE rounds have not raised the AUC."""
        while len(self.trees) < rounds and not self.stopped:
            for _ in range(min(ROUNDS, rounds - len(self.trees))):
                seed = int(np.random.SeedSequence([self.seed, len(self.trees)]).generate_state(1)[0])
                self.trees.append(grown_tree(self.blocks, self.trees[self.written :], self.cuts, self.params, seed))
            if self.validated:
                self.aucs += prefix_auc(self.blocks, self.trees[self.written :])
                self.stopped = self.plain_loop()[1]
            self.write_margins()

    def plain_loop(self) -> tuple[int, bool]:
        """The best round of a loop that ends after ``patience`` rounds without gain, and whether it ended."""
        best = 0
        for i in range(1, len(self.aucs)):
            if (self.aucs[i] or -1.0) > (self.aucs[best] or -1.0):
                best = i
            elif i - best >= self.patience:
                return best, True
        return best, False

    def stop_round(self) -> int:
        return self.plain_loop()[0]

    def write_margins(self) -> None:
        trees = self.trees[self.written :]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                margins = [own["margin"].tobytes() for own in unpacked(batch, trees)]
                kept = [batch.column(c) for c in ("rows", *BLOCK[:-1])]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(margins, pa.binary())], names=["rows", *BLOCK])

        old = self.own_copy
        self.blocks = self.own_copy = materialize(self.blocks.mapInArrow(run, BLOCK_SQL))
        self.written = len(self.trees)
        if old is not None:
            release_copy(old)

    def model(self) -> TreeModel:
        count = self.stop_round() + 1 if self.validated and self.aucs else len(self.trees)
        return TreeModel(self.features, self.trees[:count], dict(self.params))


def model_table(spark: SparkSession, model: TreeModel) -> DataFrame:
    """One row per node: its size is that of the model."""
    names = list(vars(Tree()))
    rows = [(t, i, *(getattr(tree, n)[i] for n in names)) for t, tree in enumerate(model.trees) for i in range(len(tree.feature))]
    columns = list(zip(*rows)) or [()] * (2 + len(names))
    kinds = {"threshold": pa.float64(), "missing_left": pa.bool_(), "value": pa.float64(), "gain": pa.float64(), "cover": pa.float64()}
    arrays = [pa.array(c, kinds.get(n, pa.int32())) for n, c in zip(["tree", "node", *names], columns)]
    return spark.createDataFrame(pa.table(arrays, names=["tree", "node", *names]))


def model_of(nodes: DataFrame, features: Sequence[str], params: dict[str, float]) -> TreeModel:
    """The model whose ``model_table`` is ``nodes``."""
    trees: dict[int, Tree] = {}
    for row in nodes.orderBy("tree", "node").collect():  # as many rows as the model has nodes
        tree = trees.setdefault(row["tree"], Tree(*([] for _ in vars(Tree()))))
        for name in vars(tree):
            getattr(tree, name).append(row[name])
    return TreeModel(list(features), list(trees.values()), params)
