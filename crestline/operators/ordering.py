"""Per-key ordering: latest row, top n, dense ordinals, average ranks.

Row numbers under a hard upper bound (``latest``, ``top_n``) are cut per input
partition before the shuffle, so a hot key costs at most n rows per task.
Ordinals and ranks over whole groups have no such bound: they are counted per slice of
the order first, and a task orders one slice of one group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def top_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "_rn"
) -> DataFrame:
    """First ``n`` rows per key under ``order``; ``name`` holds the 1-based position."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order``."""
    return top_n(df, keys, order, 1, "_rn").drop("_rn")


def group_ordinal(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_by: Column,
    name: str = "ordinal",
    size: str = "group_size",
) -> DataFrame:
    """1-based position of each row in its group and the group's size, for groups of any size.

    ``order`` must be a total order within a group, and ``slice_by`` a coarse function of it that
    never falls along the order (the hour of a leading timestamp, say). Rows are counted per
    group and slice with map-side sums; a row's position is its place in its slice plus the
    rows of earlier slices. A task holds a slice of a group, never a whole group. Null keys
    are a group, a null slice is the first one.
    """
    rows = df.withColumns({"_g": F.struct(*keys), "_s": F.struct(slice_by.alias("s"))})
    group = Window.partitionBy("_g")
    before = group.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    slices = rows.groupBy("_g", "_s").agg(F.count("*").alias("_n")).select(
        "_g", "_s", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(group).alias(size),
    )
    place = F.row_number().over(Window.partitionBy("_g", "_s").orderBy(*order))
    return rows.join(slices, ["_g", "_s"]).withColumn(name, place + F.col("_before")).select(*df.columns, name, size)


#: slices that ``squashed`` tells apart
SLICES = 10_000


def squashed(value: Column, middle: float = 50.0, spread: float = 50.0, slices: int = SLICES) -> Column:
    """A slice number that grows with any number and stays below ``slices``; finest around ``middle``."""
    share = F.atan((value - middle) / spread) / math.pi + 0.5
    return F.least(F.floor(share * slices), F.lit(slices - 1)).cast("int")


def average_ranks(counts: DataFrame, value: str, count: str, name: str) -> DataFrame:
    """``counts`` (one row per distinct ``value`` and its number of rows) with the rank that equal rows share.

    Distinct values are summed by slice first: at most ``SLICES`` rows meet in one task, and
    every slice adds up its own values.
    """
    sliced = counts.withColumn("_s", squashed(F.col(value)))
    upto = Window.orderBy("_s").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy("_s").agg(F.sum(count).alias("_n")).select(
        "_s", F.coalesce(F.sum("_n").over(upto), F.lit(0)).alias("_before")
    )
    inner = Window.partitionBy("_s").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (
        sliced.join(F.broadcast(offsets), "_s")  # at most SLICES rows
        .withColumn(name, F.coalesce(F.sum(count).over(inner), F.lit(0)) + F.col("_before") + (F.col(count) + 1) / 2)
        .drop("_s", "_before")
    )


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row ``spearman``: the correlation of the ranks of two numbers, ties sharing their mean rank.

    Rows are folded to counts of distinct pairs; ranks come from the counts of each side. The pairs of
    one x are summed map-side before they meet its rank, so a frequent value reaches no task as rows.
    Rows with a missing number are left out; without spread the result is null.
    """
    pairs = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).filter("x is not null and y is not null").groupBy("x", "y").agg(
        F.count("*").alias("c")
    )
    side = {
        v: average_ranks(pairs.groupBy(v).agg(F.sum("c").alias(f"n{v}")), v, f"n{v}", f"r{v}") for v in ("x", "y")
    }
    per_x = pairs.join(side["y"], "y").groupBy("x").agg(F.sum(F.col("c") * F.col("ry")).alias("sy"))
    crossed = side["x"].join(per_x, "x").agg(
        F.sum("nx").alias("n"), F.sum(F.col("rx") * F.col("sy")).alias("xy"), F.sum(F.col("nx") * F.col("rx") * F.col("rx")).alias("xx")
    )
    own = side["y"].agg(F.sum(F.col("ny") * F.col("ry") * F.col("ry")).alias("yy"))
    # ranks average (n + 1) / 2 on either side
    level = F.col("n") * (F.col("n") + 1.0) * (F.col("n") + 1.0) / 4
    spread = F.sqrt((F.col("xx") - level) * (F.col("yy") - level))
    return crossed.withColumn("yy", own.scalar()).select(F.try_divide(F.col("xy") - level, spread).alias("spearman"))
