"""Minority oversampling between neighbours (ML-05)."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.functions.expressions import hash_order
from fraudlake.operators.running import running_totals
from fraudlake.operators.split import first_key
from fraudlake.session import materialize

BLOCK_ROWS = 2048
MAX_PIVOTS = 1024
ASKED_ROWS = 8192  # points that one task compares with a group of blocks
GROUP_VALUES = 1 << 20  # numbers in the vectors of a group of blocks
TILE = 1 << 22  # numbers in a matrix inside a task
EPS = np.finfo("float64").eps


def nearest_neighbors(points: DataFrame, rows: int, *args, **kwargs) -> DataFrame:
    """(id, neighbor, rank 1..k): ``neighbor_distances`` without the distances."""
    return neighbor_distances(points, rows, *args, **kwargs).drop("distance")


def neighbor_distances(
    points: DataFrame,
    rows: int,
    row_id: str = "TransactionID",
    vector: str = "features",
    dimensions: int = 1,
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """(id, neighbor, rank 1..k, squared distance) among ``points`` (id, array<double>): the exact nearest.

    A metric partition. At most 1024 points, drawn by a seeded hash, are pivots; every point belongs to
    the ball of its nearest pivot. The points are ranked by (ball, distance to its pivot) and cut into
    equal blocks of at most 2048 consecutive ranks, so a ball of any size, or a value that a third of
    the points share, is spread over blocks. A search inside the own block gives a bound, and by the
    triangle inequality a point then visits only blocks with a ring of a ball that its bound reaches:
    the ring is neither too far from nor too near to its pivot, and the border between the two balls
    is near enough. A point travels once for a group of blocks of about 8 MB. Pairs are first
    judged by a matrix product with its rounding error; only those that may be among the nearest have their
    distance taken, term by term. With many independent features the bound may reach all blocks; the
    products then grow with the square of the points, the distances taken do not.

    Ties go to the smaller id among the points compared. A point with k others at distance 0 in its own
    block looks no further, so repeated points are not paired with all their copies.
    """
    blocks = max(1, -(-rows // BLOCK_ROWS))
    found_schema = f"{row_id} long, neighbor long, distance double"
    best = Window.partitionBy(row_id).orderBy("distance", "neighbor")

    def nearest(pairs: DataFrame) -> DataFrame:
        ranked = pairs.withColumn("rank", F.row_number().over(best))
        return ranked.where(F.col("rank") <= k).select(row_id, "neighbor", "rank", "distance")

    if blocks == 1:
        found = points.select(row_id, vector, F.lit(0).alias("_block"))
        return nearest(found.groupBy("_block").applyInPandas(_block_search(row_id, vector, k), found_schema))

    drawn = points.orderBy(hash_order(F.col(row_id), seed), row_id).limit(min(MAX_PIVOTS, 2 * blocks))
    pivots = np.array([r[0] for r in drawn.select(vector).collect()], dtype="float64")
    pivots = pivots[np.isfinite(pivots).all(axis=1)]
    if not len(pivots):
        pivots = np.zeros((1, dimensions))

    def to_balls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(vector), dimensions)
            distance, slack = _pivot_distances(x, pivots)
            ball = np.argmin(np.nan_to_num(distance, nan=np.inf), axis=1)
            own = distance[np.arange(len(x)), ball]
            # One number that orders by ball, then by distance; balls meet at whole numbers.
            along = ball + np.nan_to_num(own / (1 + own), nan=1.0) * 0.5
            yield pa.RecordBatch.from_arrays(
                [batch.column(row_id), *(pa.array(v) for v in (ball.astype("int64"), own, slack, along))],
                names=[row_id, "_ball", "_from", "_slack", "_along"],
            )

    balls = materialize(
        points.select(row_id, vector).mapInArrow(
            to_balls, f"{row_id} long, _ball long, _from double, _slack double, _along double"
        )
    )
    ranked = running_totals(balls, "_along", {"_position": F.lit(1)}, ties=row_id)
    block = F.floor((F.col("_position") - 1) * blocks / rows).cast("long").alias("_block")
    blocked = materialize(points.select(row_id, vector).join(ranked.select(row_id, "_ball", "_from", "_slack", block), row_id))
    inside = blocked.select(row_id, vector, "_block").groupBy("_block")
    found = materialize(inside.applyInPandas(_block_search(row_id, vector, k), found_schema))
    more = _other_blocks(blocked, found, pivots, row_id, vector, dimensions, k, found_schema)
    return nearest(found.unionByName(more))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(-1, dimensions)


def _pivot_distances(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distances of rows to pivots, and per row how far rounding may have moved them."""
    with np.errstate(all="ignore"):
        centre = pivots.mean(axis=0)
        x, p = x - centre, pivots - centre
        lengths, ends = (x * x).sum(axis=1), (p * p).sum(axis=1)
        squares = lengths[:, None] + ends[None] - 2 * (x @ p.T)
        return np.sqrt(np.maximum(squares, 0)), np.sqrt(8 * (x.shape[1] + 4) * EPS * (lengths + ends.max()))


def _other_blocks(
    blocked: DataFrame, found: DataFrame, pivots: np.ndarray, row_id: str, vector: str, dimensions: int, k: int, schema: str
) -> DataFrame:
    """Pairs of points and their nearest in the other blocks that may hold something nearer than found.

    The rings, at most one per block and pivot together, go through the driver.
    """
    rings = (
        blocked.groupBy("_block", "_ball")
        .agg(
            F.min(F.col("_from") - F.col("_slack")).alias("low"),
            F.max(F.col("_from") + F.col("_slack")).alias("high"),
            F.max("_slack").alias("slack"),
        )
        .orderBy("_block", "_ball")
        .toPandas()
    )
    ring_block, ring_ball = rings["_block"].to_numpy(), rings["_ball"].to_numpy()
    low, high, loose = (rings[c].to_numpy() for c in ("low", "high", "slack"))
    together = max(1, GROUP_VALUES // (BLOCK_ROWS * dimensions))
    step = max(1, TILE // len(rings))

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                distance, slack = _pivot_distances(_matrix(part.column(vector), dimensions), pivots)
                bound = part.column("distance").to_numpy()
                radius = (np.sqrt(bound) * (1 + 1e-12) + slack)[:, None]
                own_ball, own_block = part.column("_ball").to_numpy(), part.column("_block").to_numpy()
                to = distance[:, ring_ball]
                border = (to - distance[np.arange(len(to)), own_ball][:, None]) / 2
                # Comparisons that fail where a value is not finite keep the ring.
                away = (to - radius > high) | (to + radius < low) | (border > radius + loose)
                row, ring = np.nonzero(~away)
                block = ring_block[ring]
                visits = np.unique(np.stack([row, block], axis=1)[block != own_block[row]], axis=0)
                if not len(visits):
                    continue
                row, block = visits[:, 0], visits[:, 1]
                group = block // together
                first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (group[1:] != group[:-1])])
                offsets = pa.array(np.r_[first, len(row)].astype("int32"))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(row_id).take(pa.array(row[first])), pa.array(group[first]),
                        pa.array(bound[row[first]]), pa.ListArray.from_arrays(offsets, pa.array(block)),
                    ],
                    names=[row_id, "_group", "_bound", "_visits"],
                )

    bound = F.when(F.count("*") < k, float("inf")).otherwise(F.max("distance")).alias("distance")
    bound = found.groupBy(row_id).agg(bound).where("distance > 0")
    asking = blocked.join(bound, row_id).select(row_id, vector, "_ball", "_block", "distance")
    sent = materialize(asking.mapInArrow(reached, f"{row_id} long, _group long, _bound double, _visits array<long>"))
    parts = materialize(sent.groupBy("_group").agg(F.ceil(F.count("*") / ASKED_ROWS).alias("_parts")))
    asked = (
        sent.join(F.broadcast(parts), "_group")
        .withColumn("_part", F.pmod(F.xxhash64(row_id), F.col("_parts")))
        .drop("_parts")
        .join(blocked.select(row_id, vector), row_id)
    )
    group = F.floor(F.col("_block") / together).cast("long").alias("_group")
    copies = blocked.select(F.col(row_id).alias("neighbor"), F.col(vector).alias("_toward"), "_block", group)
    copies = copies.join(F.broadcast(parts), "_group").withColumn(
        "_part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_parts") - 1))
    )

    def compare(asked: pd.DataFrame, group: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(asked) and len(group):
            ids, bound = asked[row_id].to_numpy(), asked["_bound"].to_numpy().copy()
            x = np.stack(asked[vector].to_numpy())
            row = np.repeat(np.arange(len(ids)), asked["_visits"].str.len())
            visit = np.concatenate(asked["_visits"].to_numpy())
            for number, block in group.sort_values("neighbor").groupby("_block"):
                some = row[visit == number]
                if len(some):
                    y = np.stack(block["_toward"].to_numpy())
                    pairs, _ = nearest_pairs(ids[some], x[some], block["neighbor"].to_numpy(), y, k, bound[some])
                    out.append(pairs)
        if not out:
            return pd.DataFrame({row_id: [], "neighbor": [], "distance": []})
        return pd.concat(out).rename(columns={"id": row_id})

    return asked.groupBy("_group", "_part").cogroup(copies.groupBy("_group", "_part")).applyInPandas(compare, schema)


def nearest_pairs(ids, x, others, y, k: int, bound=None) -> tuple[pd.DataFrame, int]:
    """(id, neighbor, squared distance) of the k nearest of ``others`` (in id order) to each of ``ids``, itself
    left out and none beyond its ``bound``; and the number of distances taken.

    A matrix product gives every squared distance up to a known error. Pairs that even with the error cannot be
    among the k nearest are left; the others' distances are sums of squared differences in the order of
    the dimensions, so that a pair has one distance wherever it is compared.
    """
    out, taken = [], 0
    with np.errstate(all="ignore"):
        centre = y.mean(axis=0)
        ends = y - centre
        end_lengths = (ends * ends).sum(axis=1)
        step = max(1, TILE // (4 * max(1, len(others))))
        for a in range(0, len(ids), step):
            own, part = ids[a : a + step], x[a : a + step]
            starts = part - centre
            lengths = (starts * starts).sum(axis=1)
            scale = lengths[:, None] + end_lengths[None]
            squares = scale - 2 * (starts @ ends.T)
            error = scale * (8 * (x.shape[1] + 4) * EPS)
            most = squares + error
            most[np.isnan(most)] = np.inf
            same = own[:, None] == others[None]
            most[same] = np.inf
            limit = np.full(len(own), np.inf) if bound is None else bound[a : a + step].astype("float64")
            if len(others) > k:
                limit = np.minimum(limit, np.partition(most, k - 1, axis=1)[:, k - 1])
            row, column = np.nonzero(~(squares - error > limit[:, None]) & ~same)
            taken += len(row)
            distance = np.zeros(len(row))
            for j in range(x.shape[1]):
                distance += (part[row, j] - y[column, j]) ** 2
            order = np.lexsort((column, distance, row))
            row, column, distance = row[order], column[order], distance[order]
            begins = np.searchsorted(row, np.arange(len(own)))
            kept = np.arange(len(row)) - begins[row] < k
            out.append(pd.DataFrame({"id": own[row[kept]], "neighbor": others[column[kept]], "distance": distance[kept]}))
    return pd.concat(out), taken


def _block_search(row_id: str, vector: str, k: int):
    def search(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(row_id)
        ids, x = block[row_id].to_numpy(), np.stack(block[vector].to_numpy())
        return nearest_pairs(ids, x, ids, x, k)[0].rename(columns={"id": row_id})

    return search


def synthetic_minority(
    df: DataFrame,
    features: Sequence[str],
    label: str = "isFraud",
    row_id: str = "TransactionID",
    ratio: float = 0.1,
    k: int = 5,
    seed: int = 42,
) -> DataFrame | None:
    """New minority rows so that minority / majority reaches ``ratio``; None if it already does.

    Every minority row is the base of the same number of new rows, plus one for the rows that
    come first in the seeded hash order, so the total is exact. A new row lies on the segment
    from its base to one of the base's k nearest minority neighbours.
    """
    features = list(features)
    sizes = {r[label]: r["n"] for r in df.groupBy(label).agg(F.count("*").alias("n")).collect()}
    minority, majority = sizes.get(1, 0), sizes.get(0, 0)
    missing = int(ratio * majority) - minority
    if missing <= 0 or minority < 2:
        return None
    each, extra = divmod(missing, minority)

    # The minority is read again for every direction and for both ends of a segment.
    points = materialize(
        df.where(F.col(label) == 1).select(
            row_id, F.array(*[F.col(c).cast("double") for c in features]).alias("features")
        )
    )
    neighbors = nearest_neighbors(
        points, minority, row_id, "features", len(features), min(k, minority - 1), seed
    )
    fanout = neighbors.groupBy(row_id).agg(
        F.array_sort(F.collect_list(F.struct("rank", "neighbor"))).alias("near")
    )

    cut = first_key(points, row_id, seed, extra)
    copies = F.lit(each)
    if cut is not None:
        copies = copies + (hash_order(F.col(row_id), seed) <= F.lit(cut)).cast("int")
    draws = (
        points.select(row_id)
        .withColumn("copy", F.explode(F.sequence(F.lit(0), copies)))
        .where(F.col("copy") < copies)
    )

    def draw(purpose: str):
        return F.pmod(F.xxhash64(F.col(row_id), F.col("copy"), F.lit(f"{purpose}:{seed}")), F.lit(1 << 40))

    chosen = F.element_at("near", (draw("neighbor") % F.size("near") + 1).cast("int"))["neighbor"]
    planned = draws.join(fanout, row_id).select(
        row_id, "copy", chosen.alias("neighbor"), (draw("step") / float(1 << 40)).alias("step")
    )
    others = points.select(F.col(row_id).alias("neighbor"), F.col("features").alias("toward"))
    mixed = (
        planned.join(points, row_id)
        .join(others, "neighbor")
        .withColumn(
            "mixed",
            F.zip_with(
                "features", "toward", lambda x, y: x + F.col("step") * (y - x)
            ),
        )
    )
    return mixed.select(
        F.col(row_id).alias("base_id"),
        F.col("neighbor").alias("neighbor_id"),
        F.col("copy"),
        *[F.col("mixed")[i].alias(c) for i, c in enumerate(features)],
        F.lit(1).cast("long").alias(label),
    )


def oversample(
    df: DataFrame,
    features: Sequence[str],
    label: str = "isFraud",
    row_id: str = "TransactionID",
    ratio: float = 0.1,
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """The rows and the synthetic ones; synthetic rows have no id."""
    kept = df.select(row_id, F.col(label).cast("long").alias(label), *[F.col(c).cast("double").alias(c) for c in features])
    added = synthetic_minority(df, features, label, row_id, ratio, k, seed)
    if added is None:
        return kept
    return kept.unionByName(
        added.withColumn(row_id, F.lit(None).cast("long")).select(*kept.columns)
    )
