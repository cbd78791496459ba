"""The two derived views every other plan reads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crestline.functions.scalars import days_before
from crestline.operators.ordering import group_ordinal
from crestline.sources.tables import COUNTER_FLOOR_DAYS

COUNTERS = ("view_count", "like_count", "comment_count")


def counter_deltas(
    stats: DataFrame,
    as_of: date | str,
    since: int | None = None,
    counters: Sequence[str] = COUNTERS,
) -> DataFrame:
    """Snapshots with the change since the item's previous snapshot.

    The previous *row* counts, however many days back, so gaps lump. With
    ``since`` only the last ``since`` days come out: older snapshots are reduced
    to one seed row per item before the shuffle instead of being sorted along.
    """
    floor = days_before(as_of, COUNTER_FLOOR_DAYS)
    rows = stats.filter(F.col("collected_date") >= floor).select("item_id", "collected_date", *counters)
    by_day = Window.partitionBy("item_id").orderBy("collected_date")
    if since is not None:
        start = days_before(as_of, since)
        seed = (
            rows.filter(F.col("collected_date") < start)
            .groupBy("item_id")
            .agg(
                F.max("collected_date").alias("collected_date"),
                *[F.max_by(c, "collected_date").alias(c) for c in counters],
            )
        )
        rows = rows.filter(F.col("collected_date") >= start).unionByName(seed)
    out = rows.select(
        "*",
        *[
            (F.col(c) - F.lag(c).over(by_day)).alias(f"delta_{c.removesuffix('_count')}s")
            for c in counters
        ],
    )
    return out if since is None else out.filter(F.col("collected_date") >= start)


def daily_metrics(
    stats: DataFrame, items: DataFrame, as_of: date | str, since: int | None = None
) -> DataFrame:
    """Per item and day: counters, deltas, ratios, age of the item."""
    age = items.select("item_id", F.to_date("published_at").alias("_published"))
    return (
        counter_deltas(stats, as_of, since)
        .join(age, "item_id", "left")
        .select(
            "item_id", "collected_date", *COUNTERS,
            "delta_views", "delta_likes", "delta_comments",
            F.try_divide("like_count", "view_count").alias("like_view_ratio"),
            F.try_divide("comment_count", "view_count").alias("comment_view_ratio"),
            F.datediff("collected_date", "_published").alias("days_since_publish"),
        )
    )


def movie_links(items: DataFrame) -> DataFrame:
    """Items of the movie branch that are actually linked."""
    return items.filter((F.col("content_kind") == "movie") & F.col("movie_id").isNotNull())


def movie_days(
    stats: DataFrame, items: DataFrame, as_of: date | str, days: int, selective: bool = False
) -> DataFrame:
    """Per movie and day: summed counters and new views over its items.

    The per-item rows are joined on the item id and summed per (movie, day)
    with map-side partial sums, so a movie with very many items stays spread.
    ``selective`` says that ``items`` holds a small part of all items: their
    counters are picked out before the deltas instead of after.
    """
    links = movie_links(items).select("item_id", "movie_id")
    if selective:
        stats = stats.join(links.select("item_id"), "item_id", "left_semi")
    return (
        counter_deltas(stats, as_of, days, ("view_count", "like_count"))
        .join(links, "item_id")
        .groupBy("movie_id", "collected_date")
        .agg(
            F.sum("like_count").alias("likes"),
            F.sum("view_count").alias("views"),
            F.sum("delta_views").alias("delta_views"),
            F.max("view_count").alias("top_item_views"),
            F.max("delta_views").alias("top_item_delta"),
        )
    )


def score_sequence(scores: DataFrame, items: DataFrame, as_of: date | str) -> DataFrame:
    """Each scored movie item with its position in the movie's publishing order.

    Equal publishing times are ordered by item id.
    """
    kept = scores.filter(
        (F.col("scored_date") >= days_before(as_of, COUNTER_FLOOR_DAYS)) & F.col("excitement").isNotNull()
    ).select("item_id", "excitement", "model_version", "scored_date")
    links = movie_links(items).select("item_id", "movie_id", "published_at")
    placed = group_ordinal(
        kept.join(links, "item_id"), ["movie_id", "model_version"], ["published_at", "item_id"],
        F.date_trunc("hour", "published_at"), "item_ordinal", "n_items",
    )
    return placed.select(
        "movie_id", "item_id", "excitement", "model_version", "scored_date", "published_at",
        "item_ordinal", "n_items",
    )


def latest_version(scores: DataFrame, as_of: date | str) -> DataFrame:
    """One row: the version scored most recently (the greater name on a tie)."""
    return (
        scores.filter(F.col("scored_date") >= days_before(as_of, COUNTER_FLOOR_DAYS))
        .groupBy("model_version")
        .agg(F.max("scored_date").alias("_d"))
        .agg(F.max(F.struct("_d", "model_version")).alias("_m"))
        .select("_m.model_version")
        .filter(F.col("model_version").isNotNull())
    )


def current_sequence(
    scores: DataFrame, items: DataFrame, as_of: date | str, version: str | None = None
) -> DataFrame:
    """The sequence of one model version, the latest unless named."""
    if version is not None:
        chosen = scores.filter(F.col("model_version") == version)
    else:
        # a single row
        chosen = scores.join(F.broadcast(latest_version(scores, as_of)), "model_version", "left_semi")
    return score_sequence(chosen, items, as_of)


