"""The prediction log: record, resolve, score."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.functions.scalars import day
from crestline.operators.asof import next_event
from crestline.operators.upsert import patch, upsert
from crestline.plans.metrics import movie_links
from crestline.session import pin

HORIZON_DAYS = 21  # fixed value: days within which the predicted item must appear


def open_predictions(log: DataFrame) -> DataFrame:
    return log.filter(F.col("status") == "open")


def new_predictions(
    log: DataFrame, findings: DataFrame, today: date | str, now: Column, horizon_days: int = HORIZON_DAYS
) -> DataFrame:
    """Rows to open: due findings of movies without an open prediction."""
    due = findings.filter(F.col("kind") == "trailer_due")
    free = due.join(open_predictions(log).select("movie_id"), "movie_id", "left_anti")
    return free.select(
        F.concat_ws("-", F.col("movie_id").cast("string"), day(today).cast("string")).alias("prediction_id"),
        "kind", "movie_id", "title", day(today).alias("predicted_at"),
        F.lit(horizon_days).cast("bigint").alias("horizon_days"),
        F.col("days_to_release").cast("bigint").alias("days_to_release_at_prediction"),
        F.col("vs_peak").alias("vs_peak_at_prediction"), F.col("headline").alias("basis"),
        F.lit("open").alias("status"), F.lit(None).cast("date").alias("resolved_at"),
        F.lit(None).cast("string").alias("resolved_item_id"),
        F.lit(None).cast("bigint").alias("resolved_lag_days"),
        now.alias("created_at"), now.alias("updated_at"),
    )


def record_predictions(
    log: DataFrame, findings: DataFrame, today: date | str, now: Column, horizon_days: int = HORIZON_DAYS
) -> DataFrame:
    """The log with today's new predictions; running it twice changes nothing."""
    return upsert(log, new_predictions(log, findings, today, now, horizon_days), ["prediction_id"])


def resolutions(log: DataFrame, items: DataFrame, today: date | str) -> DataFrame:
    """Outcome of every open prediction: hit, miss, or still open.

    Only the earliest item published on a later day is looked at. A miss needs
    the horizon to have passed entirely.
    """
    launches = (
        movie_links(items)
        .filter(F.col("published_at").isNotNull())
        .groupBy("movie_id", F.to_date("published_at").alias("pub_day"))
        .agg(F.min_by("item_id", F.struct("published_at", "item_id")).alias("pub_item"))
    )
    # prediction ids are movie-day pairs, so a movie has one prediction per day
    pending = open_predictions(log).select("prediction_id", "movie_id", "predicted_at", "horizon_days")
    seen = next_event(pending, launches, ["movie_id"], "predicted_at", "pub_day", ["pub_item"])
    lag = F.datediff("pub_day", "predicted_at")
    is_hit = F.coalesce(lag <= F.col("horizon_days"), F.lit(False))
    is_over = F.datediff(day(today), F.col("predicted_at")) > F.col("horizon_days")
    return seen.select(
        "prediction_id", "movie_id",
        F.when(is_hit, "hit").when(is_over, "miss").otherwise("open").alias("status"),
        F.when(is_hit | is_over, day(today)).alias("resolved_at"),
        F.when(is_hit, F.col("pub_item")).alias("resolved_item_id"),
        F.when(is_hit, lag.cast("bigint")).alias("resolved_lag_days"),
    )


def resolve_predictions(log: DataFrame, items: DataFrame, today: date | str, now: Column) -> DataFrame:
    """The log after settling what can be settled today."""
    settled = resolutions(log, items, today).filter(F.col("status") != "open").withColumn("updated_at", now)
    cols = ("status", "resolved_at", "resolved_item_id", "resolved_lag_days", "updated_at")
    return patch(
        log, settled.select("prediction_id", *cols), ["prediction_id"],
        {c: (lambda c: lambda s, t: s(c))(c) for c in cols},
    )


def daily_changes(
    log: DataFrame, items: DataFrame, findings: DataFrame, today: date | str, now: Column
) -> DataFrame:
    """Whole rows of the log that today changes or adds: what is settled, then what is opened.

    Only open predictions are looked at; a movie settled today may be called again today.
    """
    done = ("status", "resolved_at", "resolved_item_id", "resolved_lag_days")
    settled = pin(resolutions(log, items, today).filter(F.col("status") != "open").select("prediction_id", *done))
    waiting = open_predictions(log)
    kept = [c for c in log.columns if c not in {*done, "updated_at"}]
    closed = waiting.select(*kept).join(settled, "prediction_id").withColumn("updated_at", now)
    still_open = waiting.join(settled, "prediction_id", "left_anti")
    return closed.select(*log.columns).unionByName(new_predictions(still_open, findings, today, now).select(*log.columns))


def daily_update(
    log: DataFrame, items: DataFrame, findings: DataFrame, today: date | str, now: Column
) -> DataFrame:
    """The log after the day: settled and opened in one merge."""
    return upsert(log, daily_changes(log, items, findings, today, now), ["prediction_id"])


def track_record(log: DataFrame) -> DataFrame:
    """Counts, hit rate (null while nothing is resolved) and mean lag of the hits."""
    status = F.col("status")
    return log.agg(
        F.count_if(status == "hit").alias("hits"),
        F.count_if(status == "miss").alias("misses"),
        F.count_if(status == "open").alias("open"),
        F.avg(F.when(status == "hit", F.col("resolved_lag_days"))).alias("avg_hit_lag_days"),
    ).select(
        "hits", "misses", "open",
        F.try_divide(F.col("hits"), F.col("hits") + F.col("misses")).alias("hit_rate"),
        "avg_hit_lag_days",
    )
