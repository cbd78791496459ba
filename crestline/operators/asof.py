"""Forward as-of lookup: the first event after (or on) a day, per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def next_event(
    points: DataFrame,
    events: DataFrame,
    keys: Sequence[str],
    point_day: str,
    event_day: str,
    payload: Sequence[str] = (),
    inclusive: bool = False,
) -> DataFrame:
    """``points`` plus the day and payload of the nearest later event of the same key.

    Both sides must hold at most one row per key and day, so that a key's share
    is bounded by the calendar. They are stacked and scanned once in day order:
    no pairs of points and events are formed.
    """
    point_cols = points.columns
    out_cols = [event_day, *payload]
    # scanning from the newest day backwards, the last event seen is the nearest later one;
    # on a shared day the point comes first unless the same day counts
    same_day = 1 if inclusive else 0
    stacked = points.select(
        *keys,
        F.col(point_day).alias("_day"),
        F.lit(same_day).alias("_turn"),
        F.struct(*point_cols).alias("_point"),
        F.lit(None).cast(events.select(F.struct(*out_cols).alias("e")).schema["e"].dataType).alias("_event"),
    ).unionByName(
        events.select(
            *keys,
            F.col(event_day).alias("_day"),
            F.lit(1 - same_day).alias("_turn"),
            F.struct(*out_cols).alias("_event"),
        ),
        allowMissingColumns=True,
    )
    seen = (
        Window.partitionBy(*keys)
        .orderBy(F.col("_day").desc(), F.col("_turn"))
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        stacked.withColumn("_next", F.last("_event", ignorenulls=True).over(seen))
        .filter(F.col("_point").isNotNull())
        .select("_point.*", *[F.col("_next")[c].alias(c) for c in out_cols])
    )
