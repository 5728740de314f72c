"""Integer codes for categories (FE-09, FE-10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fraudlake.functions.expressions import flag_code
from fraudlake.operators.running import running_totals
from fraudlake.session import materialize

# The columns that get codes, and the label of a missing value.
LABEL_COLUMNS = ["card4", "card6", "ProductCD", "DeviceType"]
MISSING = "__missing__"


def with_flag_codes(df: DataFrame, flags: Sequence[str] | None = None) -> DataFrame:
    """``M1_enc`` .. ``M9_enc`` for the flags that are present."""
    names = flags if flags is not None else [f"M{i}" for i in range(1, 10)]
    return df.withColumns({f"{c}_enc": flag_code(F.col(c)) for c in names if c in df.columns})


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(MISSING))


def label_dictionaries(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(position, value, code, rows) with code = 0-based rank in code-point order within a column.

    ``position`` is that of the column in ``columns``. All columns are counted in one scan. The ranks
    are running counts over ranges of (position, value), so the values of a large dictionary never
    meet in one task; the number of values of the columns before, one per column, is taken off.
    """
    values = F.array(*[F.struct(F.lit(i).alias("position"), _text(c).alias("value")) for i, c in enumerate(columns)])
    counted = (
        df.select(F.explode(values).alias("_label"))
        .groupBy("_label.position", "_label.value")
        .agg(F.count("*").alias("rows"))
    )
    ranked = materialize(running_totals(counted, "position", {"_place": F.lit(1).cast("long")}, ties="value"))
    first = ranked.groupBy("position").agg(F.min("_place").alias("_first"))
    return materialize(
        ranked.join(F.broadcast(first), "position").select(
            "position", "value", (F.col("_place") - F.col("_first")).alias("code"), "rows"
        )
    )


def with_label_codes(
    df: DataFrame,
    columns: Sequence[str] = tuple(LABEL_COLUMNS),
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Replace each category by its code; a value unknown to ``fit_on`` gets -1.

    The rows are joined with the written dictionaries, whose size Spark knows: it broadcasts small
    ones, and the rows are then not moved.
    """
    order = df.columns
    present = [c for c in columns if c in order]
    if not present:
        return df
    dictionaries = label_dictionaries(fit_on if fit_on is not None else df, present)
    result = df
    for i, c in enumerate(present):
        codes = dictionaries.where(F.col("position") == i).select(F.col("value").alias("_value"), F.col("code").alias("_code"))
        joined = result.join(codes, _text(c) == F.col("_value"), "left")
        result = joined.withColumn(c, F.coalesce(F.col("_code"), F.lit(-1)).cast("long")).select(*order)
    return result
