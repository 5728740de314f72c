"""Exact medians of many columns and the fill they feed (AGG-15, FE-12)."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fraudlake.session import small_table

# Which columns are filled with zero, and which with their median.
ZERO_COLUMNS = [f"C{i}" for i in range(1, 15)]
MEDIAN_IDENTITY = [f"id_{i:02d}" for i in (*range(1, 12), 13, 14, 17, 18, 19, 20, 32)]
MEDIAN_BASE = ["card2", "card3", "card5", "addr1", "addr2", "dist1", "dist2"]
DIGIT_BITS = 16  # of a 64-bit key that one pass decides
HELD_DIGITS = 1 << 24  # of 2 bytes, that a task gathers before it counts them
SIGN = np.uint64(63)


def median_targets(df: DataFrame) -> list[str]:
    wanted = {f"D{i}" for i in range(1, 16)} | set(MEDIAN_IDENTITY) | set(MEDIAN_BASE)
    return [c for c in df.columns if c in wanted or c.startswith("V")]


def exact_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Interpolated median of each column over its non-missing values; None if it has none.

    Doubles are read as 64-bit numbers of the same order, and the two middle ranks of all columns are
    found together, 16 bits a pass from the top: one aggregation counts, for every column, the next 16
    bits of the values that begin like a value in the middle. Four passes over ``df`` find the medians
    of any number of columns, whatever their values. Counts are taken in the tasks and combined before the
    shuffle, so no task holds the values of a column, and a window sees at most 2^16 counts. The driver
    gets two numbers per column and pass. NaN is missing; 0.0 and -0.0 are equal.
    """
    columns = list(columns)
    medians: dict[str, float | None] = {c: None for c in columns}
    if not columns:
        return medians
    values = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    # (column, lower or upper middle) -> (bits known so far, rank among the values that begin so)
    middle: dict[tuple[int, int], tuple[int, int | None]] = {(i, w): (0, None) for i in range(len(columns)) for w in (0, 1)}
    for known in range(0, 64, DIGIT_BITS):
        counts = _digit_counts(values, {k: prefix for k, (prefix, _) in middle.items()}, known)
        middle = _middle_digits(counts, middle, known == 0)
        if not middle:
            return medians
    for i, c in enumerate(columns):
        if (i, 0) in middle:
            a, b = _values_of([middle[i, 0][0], middle[i, 1][0]])
            medians[c] = a if a == b else (a + b) / 2 if math.isfinite(a + b) else a / 2 + b / 2
    return medians


def _ordered_keys(values: np.ndarray) -> np.ndarray:
    """64-bit numbers in the order of the doubles."""
    bits = (values + 0.0).view(np.uint64)
    return np.where(bits >> SIGN, ~bits, bits | np.uint64(1) << SIGN)


def _values_of(keys: Sequence[int]) -> list[float]:
    keys = np.array(keys, dtype=np.uint64)
    return np.where(keys >> SIGN, keys ^ np.uint64(1) << SIGN, ~keys).view(np.float64).tolist()


def _digit_counts(values: DataFrame, prefixes: dict[tuple[int, int], int], known: int) -> DataFrame:
    """(i, prefix, digit, n): how many values of column i continue a wanted prefix of ``known`` bits so."""
    wanted: dict[int, list[int]] = {}
    for (i, _), prefix in prefixes.items():
        wanted[i] = sorted({*wanted.get(i, ()), prefix})
    shift = np.uint64(64 - known - DIGIT_BITS)

    mask = np.uint64((1 << DIGIT_BITS) - 1)

    def counts(held: dict[tuple[int, int], list[np.ndarray]]) -> pa.RecordBatch:
        found = [np.zeros((4, 0), np.int64)]
        for (i, prefix), parts in held.items():
            n = np.bincount(np.concatenate(parts))
            digit = np.flatnonzero(n)
            found.append(np.stack([np.full(len(digit), i), np.full(len(digit), prefix), digit, n[digit]]))
        arrays = [pa.array(v) for v in np.concatenate(found, axis=1)]
        return pa.RecordBatch.from_arrays(arrays, names=["i", "prefix", "digit", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list[np.ndarray]] = {(i, p): [] for i, starts in wanted.items() for p in starts}
        size = 0
        for batch in batches:
            for i, starts in wanted.items():
                column = batch.column(f"c{i}").drop_null().to_numpy()
                tops = _ordered_keys(column[~np.isnan(column)]) >> shift
                begin = tops >> np.uint64(DIGIT_BITS)
                for prefix in starts:
                    digits = (tops[begin == prefix] & mask).astype(np.uint16)
                    if len(digits):
                        held[i, prefix].append(digits)
                        size += len(digits)
            if size > HELD_DIGITS:
                yield counts({k: parts for k, parts in held.items() if parts})
                held, size = {k: [] for k in held}, 0
        yield counts({k: parts for k, parts in held.items() if parts})

    counted = values.select(*[f"c{i}" for i in wanted]).mapInArrow(count, "i long, prefix long, digit long, n long")
    return counted.groupBy("i", "prefix", "digit").agg(F.sum("n").alias("n"))


def _middle_digits(counts: DataFrame, middle: dict, first: bool) -> dict:
    """The searches one digit further; in the ``first`` pass the number of values gives the ranks."""
    group = Window.partitionBy("i", "prefix")
    placed = counts.withColumn("upto", F.sum("n").over(group.orderBy("digit")))
    if first:
        n = F.sum("n").over(group)
        ranks = F.array(F.floor((n + 1) / 2), F.floor(n / 2) + 1)
        placed = placed.withColumn("ranks", ranks).select("*", F.posexplode("ranks").alias("which", "rank"))
    else:
        searches = [(i, which, prefix, rank) for (i, which), (prefix, rank) in middle.items()]
        wanted = small_table(counts.sparkSession, searches, "i long, which long, prefix long, rank long")
        placed = placed.join(F.broadcast(wanted), ["i", "prefix"])
    before = F.col("upto") - F.col("n")
    found = placed.where((before < F.col("rank")) & (F.col("rank") <= F.col("upto")))
    return {
        (r["i"], r["which"]): (r["prefix"] << DIGIT_BITS | r["digit"], r["rank"] - r["before"])
        for r in found.select("i", "which", "prefix", "digit", "rank", before.alias("before")).collect()
    }


def impute(df: DataFrame, medians: dict[str, float | None] | None = None) -> DataFrame:
    """Zero for the count columns, the median for the others; a column without values stays NULL.

    Pass ``medians`` to fill with values learned elsewhere (for example on the training rows).
    """
    if medians is None:
        medians = exact_medians(df, median_targets(df))
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in ZERO_COLUMNS if c in df.columns}
    for c, value in medians.items():
        if value is not None and c in df.columns:
            filled[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(value)))
    return df.withColumns(filled) if filled else df
