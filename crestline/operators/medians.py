"""Exact medians without gathering a group's values into one buffer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The sketch's rank error is n / ACCURACY, far inside the bracket's 0.05 % on each side.
_BRACKET = (0.4995, 0.5005)
_ACCURACY = 100_000
_STEPS = 4096


def exact_median(
    df: DataFrame, keys: Sequence[str], value: str, name: str = "median"
) -> DataFrame:
    """Median of ``value`` per key (mean of the middle two for an even count).

    ``keys`` must have a small fixed domain (bucket labels): they are broadcast.
    A quantile sketch brackets the middle; rows outside the bracket are only
    counted, rows inside are counted per distinct value. The bracket is narrowed once more by the
    counts of its steps, and the middle ranks are looked up step by step: no task orders more than one
    step's values. The result does not depend on the sketch.
    """
    present = df.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("double").alias("_v")
    )
    bracket = present.groupBy(*keys).agg(
        F.percentile_approx("_v", list(_BRACKET), _ACCURACY).alias("_b")
    )
    joined = present.join(F.broadcast(bracket), list(keys))
    low, high = F.col("_b")[0], F.col("_b")[1]
    side = F.when(F.col("_v") < low, -1).when(F.col("_v") > high, 1).otherwise(0)
    # the bracket in equal steps: a task orders the distinct values of one step
    step = F.least(F.floor(F.try_divide(F.col("_v") - low, high - low) * _STEPS), F.lit(_STEPS - 1))
    inside = F.col("_side") == 0
    counts = (
        joined.select(*keys, side.alias("_side"), F.coalesce(F.when(side == 0, step), F.lit(0)).alias("_step"), "_v")
        .withColumn("_mid", F.when(inside, F.col("_v")))
        .groupBy(*keys, "_side", "_step", "_mid")
        .agg(F.count("*").alias("_c"))
    )
    # at most _STEPS + 2 rows per key
    steps = counts.groupBy(*keys, "_side", "_step").agg(F.sum("_c").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_side", "_step").rowsBetween(Window.unboundedPreceding, -1)
    offsets = steps.select(
        *keys, "_side", "_step", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*keys)).alias("_n"),
    )
    upto = Window.partitionBy(*keys, "_side", "_step").orderBy("_mid")
    placed = counts.join(F.broadcast(offsets), [*keys, "_side", "_step"]).withColumn(
        "_cum", F.sum("_c").over(upto) + F.col("_before")
    )

    def value_at(rank):
        here = (F.col("_cum") >= rank) & (F.col("_cum") - F.col("_c") < rank)
        return F.max(F.when(here, F.col("_mid")))

    low = value_at(F.floor((F.col("_n") + 1) / 2))
    high = value_at(F.floor((F.col("_n") + 2) / 2))
    middle = (low + high) / 2
    checked = F.when(middle.isNull(), F.raise_error(F.lit("median outside its bracket"))).otherwise(
        middle
    )
    return placed.groupBy(*keys).agg(checked.cast("double").alias(name))
