"""What several operators need: tables, written intermediate frames, ranks, row keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fraudlake.session import materialize

ROWS_PER_BUCKET = 1 << 13


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stash(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read back: see ``fraudlake.session.materialize``."""
    return materialize(df)


def row_key(*columns: str) -> Column:
    """A string that is equal for rows with equal values, nulls included: 32 hex digits.

    The digest is taken of the values with their lengths, so no two different rows meet by
    concatenation.
    """
    parts = []
    for c in columns:
        text = F.col(c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat_ws("|", *parts))


def hex_digits_for(rows: int, per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Leading hex digits of a digest that make buckets of about ``per_bucket`` of ``rows``."""
    digits = 0
    while per_bucket << (4 * digits) < rows:
        digits += 1
    return digits


def with_running(
    df: DataFrame,
    group: str,
    bucket: Column,
    order: Sequence[str],
    sums: dict[str, Column],
    of_group: DataFrame | None = None,
) -> DataFrame:
    """Adds, per ``group`` (never null), the sum of all rows before each row in the order of ``order``.

    ``bucket`` cuts every group along the order into pieces small enough for one task. Their totals,
    one row per piece, are summed in a window over the pieces of a group, and a second window runs
    inside a piece; so a group of a third of all rows is never in one task. ``df`` is read twice.
    The columns of ``of_group`` (one row per ``group``) come along with the totals.
    """
    cut = df.withColumn("_bucket", bucket)
    totals = cut.groupBy(group, "_bucket").agg(*(F.sum(e).alias(f"_t_{n}") for n, e in sums.items()))
    if of_group is not None:
        totals = totals.join(of_group, group)
    more = [c for c in of_group.columns if c != group] if of_group is not None else []
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(group).alias("_group"),
        F.col("_bucket").alias("_of"),
        *(F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums),
        *more,
    )
    inside = Window.partitionBy(group, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    joined = cut.join(offsets, (F.col(group) == F.col("_group")) & (F.col("_bucket") == F.col("_of")))
    return joined.withColumns(
        {n: F.col(f"_o_{n}") + F.coalesce(F.sum(e).over(inside), F.lit(0)) for n, e in sums.items()}
    ).drop("_group", "_of", "_bucket", *(f"_o_{n}" for n in sums))


def with_pieces(rows: DataFrame, digest: str, name: str) -> DataFrame:
    """``rows`` plus the piece of each along the order of ``digest``, a row key; written and read back.

    A piece has the leading hex digits that make pieces of about 2^13 rows. Equal rows have one digest
    and would all be in one piece; where more than 2^13 rows are equal, each 2^13 of them that one
    task of the write has form a piece of their own, after the other digests with these digits and
    before the next digits. There is at most one such digest per 2^13 rows; they are joined as a written table,
    which Spark broadcasts only while it is small.
    """
    written = stash(rows.withColumn(name, F.monotonically_increasing_id()))
    digits = hex_digits_for(written.count(), ROWS_PER_BUCKET)
    heavy = stash(
        written.groupBy(F.col(digest).alias("_heavy")).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > ROWS_PER_BUCKET).select("_heavy")
    )
    part = F.lpad(F.hex(F.floor(F.col(name) / ROWS_PER_BUCKET)), 16, "0")
    own = F.concat("_heavy", part)
    leading = F.substring(digest, 1, digits) if digits else F.lit("")
    return written.join(heavy, F.col(digest) == F.col("_heavy"), "left").withColumn(
        name, F.coalesce(own, leading)
    ).drop("_heavy")


def different_texts(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, digest, copies)``, written: the different texts of each group of ``rows`` (text not null)."""
    return stash(rows.select(*by, F.md5("text").alias("digest")).groupBy(*by, "digest").agg(F.count("*").alias("copies")))


def drawn_texts(rows: DataFrame, different: DataFrame, about: int, by: Sequence[str] = ()) -> DataFrame:
    """``(*by, text)``: of each group all its different texts, or ``about`` of them chosen by their digests.

    Copies are folded before the draw, so a text that many rows share is one candidate: it neither fills
    the sample nor empties it, and a group is never without a text. Digests that a first cut leaves are
    about 1.25 times the sample and are ranked in a window; only the texts drawn are shuffled, and the rows of one text
    are folded in their tasks. ``about`` times the groups must be few enough to broadcast their digests.
    """
    group = list(by) or [F.lit(0)]
    size = F.sum(F.lit(1)).alias("_different")
    place = F.conv(F.substring("digest", 1, 8), 16, 10).cast("double") / float(1 << 32)
    if by:
        sized = different.join(F.broadcast(different.groupBy(*by).agg(size)), list(by))
    else:
        sized = different.withColumn("_different", different.agg(size).scalar())
    near = sized.where(place * F.col("_different") <= 1.25 * about + 64)
    first = F.row_number().over(Window.partitionBy(*group).orderBy("digest"))
    drawn = near.withColumn("_rank", first).where(F.col("_rank") <= about).select(*by, "digest")
    texts = rows.select(*by, "text", F.md5("text").alias("digest")).join(F.broadcast(drawn), [*by, "digest"])
    return texts.groupBy(*by, "digest").agg(F.first("text").alias("text")).drop("digest")
