"""Sharding by a minimax contiguous partition of atomic groups.

Method. Documents with equal text form a group that stays together. Groups as large as the mean of
what is left to share get a shard of their own, largest first. The others are ordered by the MD5 of
the text. A capacity is feasible if filling shard after shard greedily, each up to the group that
would exceed it, needs no more than the shards left. The smallest feasible capacity is found by
binary search, and the cuts it gives are the shards.

The order is never sorted in one place. Spark sums sizes by the leading digits of the digest. Taking
such cells as whole groups gives a capacity that suffices, taking them as divisible one that is
needed; a cut lies between the two. Only the cells between are summed by further digits, until every
cut is known to the group: about 4,096 cells first, then 256 for each of the few open ones, whatever
the number of documents. The passes read a written copy of narrow rows.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fraudlake.llm.common import row_key, table, with_pieces, with_running

FIRST_DIGITS, MORE_DIGITS = 3, 2
SHARDS = 8

Cell = tuple[str, int, bool]  # leading digits, size, whether it is one group


def least(low: int, high: int, suffices: Callable[[int], bool]) -> int:
    """Smallest number from ``low`` on that suffices; ``high`` does."""
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if suffices(middle) else (middle + 1, high)
    return low


class Line:
    """Cells in order, and greedy filling along them."""

    def __init__(self, cells: list[Cell], shards: int):
        self.cells, self.shards = cells, shards
        self.ends = list(accumulate(size for _, size, _ in cells))
        self.total = self.ends[-1] if cells else 0

    def whole(self, limit: int) -> int:
        """How far whole cells reach within ``limit``."""
        at = bisect_right(self.ends, limit)
        return self.ends[at - 1] if at else 0

    def divided(self, limit: int) -> int:
        """The same if cells of several groups can be divided anywhere."""
        at = bisect_right(self.ends, limit)
        if at < len(self.cells) and not self.cells[at][2]:
            return limit
        return self.whole(limit)

    def stops(self, reach: Callable[[int], int], capacity: int) -> list[int]:
        """Where each shard ends when filled greedily."""
        out, at = [], 0
        for _ in range(self.shards):
            at = min(self.total, reach(at + capacity))
            out.append(at)
        return out

    def smallest(self, reach: Callable[[int], int]) -> int:
        return least(0, self.total, lambda c: self.stops(reach, c)[-1] >= self.total)

    def open_cells(self) -> list[Cell]:
        """Cells of several groups in which a cut of the best partition may lie."""
        from_ = self.stops(self.whole, self.smallest(self.divided))
        to = self.stops(self.divided, self.smallest(self.whole))
        between: set[int] = set()
        for a, b in zip(from_, to):
            between.update(range(bisect_right(self.ends, a), min(bisect_right(self.ends, b) + 1, len(self.cells))))
        return [self.cells[i] for i in sorted(between) if not self.cells[i][2]]

    def cuts(self) -> list[str]:
        """The first digits of each shard after the first; the last ones may have no cell left."""
        stops = self.stops(self.whole, self.smallest(self.whole))
        starts = (bisect_right(self.ends, s) for s in stops[:-1])
        return [self.cells[i][0] for i in starts if i < len(self.cells)]


def summed_cells(rows: DataFrame, digits: int) -> list[Cell]:
    found = (
        rows.groupBy(F.substring("digest", 1, digits).alias("cell"))
        .agg(F.sum("size").alias("size"), (F.min("digest") == F.max("digest")).alias("single"))
        .collect()
    )
    return sorted((r["cell"], r["size"], r["single"]) for r in found)


def partition(rows: DataFrame, shards: int) -> tuple[list[str], list[str]]:
    """Digests of groups with a shard of their own, and the digits at which later shards begin.

    ``rows`` has ``digest`` and ``size`` and is read once per pass.
    """
    left = rows.agg(F.sum("size")).first()[0] or 0
    largest = rows.groupBy("digest").agg(F.sum("size").alias("size")).orderBy(F.desc("size"), "digest").limit(shards - 1)
    alone: list[str] = []
    for digest, size in largest.collect() if shards > 1 else []:
        if size * (shards - len(alone)) < left or len(alone) == shards - 1:
            break
        alone.append(digest)
        left -= size
    rest = rows.where(~F.col("digest").isin(alone)) if alone else rows
    cells = summed_cells(rest, FIRST_DIGITS)
    while True:
        line = Line(cells, shards - len(alone))
        unknown = line.open_cells()
        if not unknown:
            return alone, line.cuts()
        # Cells of one length at a time, the longest first; they come from the latest pass.
        digits = max(len(c[0]) for c in unknown)
        chosen = {c[0] for c in unknown if len(c[0]) == digits}
        inside = rest.where(F.substring("digest", 1, digits).isin(sorted(chosen)))
        cells = sorted([*(c for c in cells if c[0] not in chosen), *summed_cells(inside, digits + MORE_DIGITS)])


def shard_documents(docs: DataFrame, keep: list[str], text: str = "text", shards: int = SHARDS) -> DataFrame:
    """``keep`` columns, ``size``, ``digest`` (MD5 of the text), ``shard`` and ``slot`` of every row.

    The size is the UTF-8 bytes of the text and 1; null and empty texts have the size 1 and form one
    group. Slots number the rows of a shard from 0 without a gap, in the order of a digest of the
    row. Repeated rows get slots of their own. Shards may stay empty if there are fewer groups.
    """
    texts = F.coalesce(F.col(text), F.lit(""))
    narrow = with_pieces(
        docs.select(
            *(F.col(c).alias(f"c{i}") for i, c in enumerate(keep)),
            (F.octet_length(texts).cast("long") + 1).alias("size"),
            F.md5(texts.cast("binary")).alias("digest"),
            row_key(*dict.fromkeys([*keep, text])).alias("order"),
        ),
        "order",
        "piece",
    )
    alone, cuts = partition(narrow.select("digest", "size"), shards)
    shard = F.lit(len(alone))
    for cut in cuts:
        shard = shard + (F.col("digest") >= cut).cast("int")
    for i, digest in enumerate(alone):
        shard = F.when(F.col("digest") == digest, i).otherwise(shard)
    placed = narrow.withColumn("shard", shard.cast("int"))
    numbered = with_running(placed, "shard", F.col("piece"), ["order"], {"slot": F.lit(1).cast("long")})
    return numbered.select(*(F.col(f"c{i}").alias(c) for i, c in enumerate(keep)), "size", "digest", "shard", "slot")


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn(
        "text_crc32", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    )
    return shard_documents(docs, ["doc_id", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
