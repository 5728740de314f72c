"""A robust-pruned directed graph over vectors: built and searched for many points at once."""

from __future__ import annotations

import numpy as np

DEGREE = 32
BUILD_BEAM = 64
RELAX = 1.2
BATCH = 512  # points inserted, pruned or searched at once
FIRST = 64  # points that start the graph, each with all others as candidates
NONE = -1


def lifted(vectors: np.ndarray) -> np.ndarray:
    """Vectors with one more coordinate that makes them equally long, scaled by one power of two.

    Among them the nearest to a query (with 0 added) is the one with the largest inner product. The
    scale brings the largest component to 0.5 to 1, so no square overflows or vanishes.
    """
    vectors = np.asarray(vectors, np.float64)
    vectors = np.ldexp(vectors, -int(np.frexp(np.abs(vectors).max(initial=0))[1]))
    squares = np.einsum("ij,ij->i", vectors, vectors)
    extra = np.sqrt(np.maximum(0, squares.max(initial=0) - squares))
    return np.column_stack((vectors, extra))


def directions(vectors: np.ndarray) -> np.ndarray:
    """Queries of length 1 with 0 added: the length of a query does not change its order of points."""
    vectors = np.asarray(vectors, np.float64)
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    return np.column_stack((vectors / norms[:, None], np.zeros(len(vectors))))


class PrunedGraph:
    """``edges[i]``: up to DEGREE neighbours of point i, filled up with NONE.

    Distances are taken in double precision, in which squares of single-precision points are exact
    enough to tell points apart that differ in their last bits.
    """

    def __init__(self, points: np.ndarray, edges: np.ndarray | None = None, entry: int = 0):
        self.points = np.ascontiguousarray(points, np.float64)
        self.squares = np.einsum("ij,ij->i", self.points, self.points)
        self.entry = entry
        self.edges = edges if edges is not None else np.full((len(points), DEGREE), NONE, np.int32)
        if edges is None and len(points):
            self.build()

    def build(self) -> None:
        """Inserts the points in a mixed order, in batches no larger than what is there."""
        n = len(self.points)
        centre = self.points.mean(axis=0)
        self.entry = int((self.squares - 2 * self.points @ centre).argmin())
        order = np.random.default_rng(n).permutation(n)
        order = np.concatenate(([self.entry], order[order != self.entry]))
        first = order[:FIRST]
        self.join(first, np.tile(first, (len(first), 1)))
        done = len(first)
        while done < n:
            batch = order[done : done + min(done, BATCH)]
            self.join(batch, self.search(self.points[batch], BUILD_BEAM)[2])
            done += len(batch)

    def join(self, batch: np.ndarray, candidates: np.ndarray) -> None:
        """Gives each point of ``batch`` pruned edges to its candidates, and these edges back."""
        self.edges[batch] = self.pruned(batch, candidates)
        source = np.repeat(batch, DEGREE)
        target = self.edges[batch].ravel()
        back = (target != NONE) & ~(self.edges[np.maximum(target, 0)] == source[:, None]).any(axis=1)
        source, target = source[back], target[back]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        # Each round brings a point DEGREE new edges at most; what is too much is pruned again.
        place = np.arange(len(target)) - np.searchsorted(target, target)
        for low in range(0, int(place.max(initial=-1)) + 1, DEGREE):
            now = (place >= low) & (place < low + DEGREE)
            points, row = np.unique(target[now], return_inverse=True)
            wide = np.full((len(points), 2 * DEGREE), NONE, np.int32)
            wide[:, :DEGREE] = self.edges[points]
            wide[row, DEGREE + place[now] - low] = source[now]
            wide = np.where(wide == points[:, None], NONE, wide)
            full = (wide != NONE).sum(axis=1) > DEGREE
            few = np.take_along_axis(wide[~full], np.argsort(wide[~full] == NONE, axis=1, kind="stable"), axis=1)
            self.edges[points[~full]] = few[:, :DEGREE]
            for a in range(0, int(full.sum()), BATCH):
                some = np.flatnonzero(full)[a : a + BATCH]
                self.edges[points[some]] = self.pruned(points[some], wide[some])

    def pruned(self, of: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """DEGREE diverse ones of the candidates of each point, nearest first.

        A candidate goes once a chosen one is nearer to it, by the factor RELAX, than the point is.
        """
        valid = (candidates != NONE) & (candidates != of[:, None])
        ids = np.where(valid, candidates, 0)
        near = self.points[ids]
        own = self.squares[of][:, None] + self.squares[ids] - 2 * np.einsum("bcd,bd->bc", near, self.points[of])
        own = np.where(valid, np.maximum(own, 0), np.inf)
        order = np.argsort(own, axis=1, kind="stable")
        ids, own, near = (
            np.take_along_axis(ids, order, axis=1),
            np.take_along_axis(own, order, axis=1),
            np.take_along_axis(near, order[:, :, None], axis=1),
        )
        squares = self.squares[ids]
        between = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(near, near.transpose(0, 2, 1))
        alive = np.isfinite(own)
        chosen = np.full((len(of), DEGREE), NONE, np.int32)
        rows = np.arange(len(of))
        for i in range(DEGREE):
            pick = alive.argmax(axis=1)
            open_ = alive[rows, pick]
            if not open_.any():
                break
            chosen[open_, i] = ids[open_, pick[open_]]
            alive &= RELAX**2 * between[rows, pick] > own
            alive[rows, pick] = False
        return chosen

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Beam search from the entry: ``(ids, distances, expanded)``, a row per query.

        The ids are those of the ``beam`` nearest points met, nearest first, filled up with NONE;
        ``expanded`` has all points whose edges were followed. Distances are squared, without the
        query's own square.
        """
        m = len(queries)
        queries = np.ascontiguousarray(queries, np.float64)
        seen = np.zeros((m, len(self.points)), bool)
        ids = np.full((m, beam), NONE, np.int32)
        far = np.full((m, beam), np.inf)
        closed = np.ones((m, beam), bool)
        ids[:, 0], closed[:, 0], seen[:, self.entry] = self.entry, False, True
        far[:, 0] = self.squares[self.entry] - 2 * queries @ self.points[self.entry]
        expanded = []
        while True:
            live = np.flatnonzero(~closed.all(axis=1))
            if not len(live):
                break
            pick = (~closed[live]).argmax(axis=1)
            node = ids[live, pick]
            closed[live, pick] = True
            step = np.full(m, NONE, np.int32)
            step[live] = node
            expanded.append(step)
            near = self.edges[node]
            new = (near != NONE) & ~seen[live[:, None], np.maximum(near, 0)]
            row, col = np.nonzero(new)
            found = near[row, col]
            seen[live[row], found] = True
            distance = self.squares[found] - 2 * np.einsum("ij,ij->i", queries[live[row]], self.points[found])
            more = np.full(near.shape, np.inf)
            more[row, col] = distance
            all_ids = np.concatenate((ids[live], near), axis=1)
            all_far = np.concatenate((far[live], more), axis=1)
            all_closed = np.concatenate((closed[live], ~new), axis=1)
            order = np.argsort(all_far, axis=1, kind="stable")[:, :beam]
            far[live] = np.take_along_axis(all_far, order, axis=1)
            ids[live] = np.where(np.isinf(far[live]), NONE, np.take_along_axis(all_ids, order, axis=1))
            closed[live] = np.take_along_axis(all_closed, order, axis=1) | (ids[live] == NONE)
        return ids, far, np.stack(expanded, axis=1) if expanded else np.zeros((m, 0), np.int32)
