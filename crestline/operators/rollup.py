"""Band counts and medians overall and per size bucket."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.operators.medians import exact_median
from crestline.session import pin

ALL = "all"


def size_bucket(n: Column, edges: Sequence[tuple[str, int, int | None]]) -> Column:
    """Label of the bucket holding ``n``; null when none does."""
    out = F.lit(None).cast("string")
    for label, lo, hi in reversed(edges):
        inside = (n >= lo) if hi is None else n.between(lo, hi)
        out = F.when(inside, F.lit(label)).otherwise(out)
    return out


def banded_rollup(
    units: DataFrame,
    value: str,
    size: str,
    edges: Sequence[tuple[str, int, int | None]],
    band: float,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """One row overall and one per bucket, empty buckets included with 0 units.

    Columns: bucket, units, below (< -band), within, above (> band),
    below_share, median, then ``extra`` aggregates. The units are few next to
    the history they were fitted on, and are read three times: they are pinned.
    """
    labels = [ALL, *[label for label, _, _ in edges]]
    units = pin(units)
    rows = units.select(
        F.explode(F.array_compact(F.array(F.lit(ALL), size_bucket(F.col(size), edges)))).alias("bucket"),
        *units.columns,
    )
    v = F.col(value)
    sums = rows.groupBy("bucket").agg(
        F.count("*").alias("units"),
        F.count_if(v < -band).alias("below"),
        F.count_if(v > band).alias("above"),
        *extra,
    )
    medians = exact_median(rows, ["bucket"], value)
    frame = units.sparkSession.createDataFrame(
        [(i, b) for i, b in enumerate(labels)], "bucket_no int, bucket string"
    )
    n = F.coalesce("units", F.lit(0))
    # three tables of at most a handful of rows each
    return (
        frame.join(F.broadcast(sums), "bucket", "left")
        .join(F.broadcast(medians), "bucket", "left")
        .select(
            "bucket",
            n.alias("units"),
            F.coalesce("below", F.lit(0)).alias("below"),
            (n - F.coalesce("below", F.lit(0)) - F.coalesce("above", F.lit(0))).alias("within"),
            F.coalesce("above", F.lit(0)).alias("above"),
            F.try_divide(F.col("below"), F.col("units")).alias("below_share"),
            "median",
            *[c for c in sums.columns if c not in {"bucket", "units", "below", "above"}],
        )
    )
