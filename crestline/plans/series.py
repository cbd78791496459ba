"""A matched pair of view curves: a movie with many items against one with few."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crestline.operators.asof import next_event
from crestline.plans.metrics import movie_days, movie_links
from crestline.session import pin

# Candidate and pairing thresholds.
WINDOW_DAYS = 120
MIN_PEAK_VIEWS = 100_000
MIN_DAYS = 10
MANY_ITEMS, MANY_MIN_DAYS, MANY_FALLBACK = 8, 40, 3
FEW_ITEMS = 4
DAY_TOLERANCES = (4, 8, 15, 30)


def view_candidates(
    stats: DataFrame, items: DataFrame, movies: DataFrame, as_of: date | str,
    min_peak: int = MIN_PEAK_VIEWS, min_days: int = MIN_DAYS,
) -> DataFrame:
    """Movies with a real audience and enough history."""
    published = (
        movie_links(items)
        .filter(F.col("published_at").isNotNull())
        .groupBy("movie_id")
        .agg(F.count("*").alias("n_items"), F.to_date(F.min("published_at")).alias("first_pub"))
    )
    views = (
        movie_days(stats, items, as_of, WINDOW_DAYS)
        .groupBy("movie_id")
        .agg(F.max("top_item_views").alias("peak_views"), F.count("*").alias("days"))
        .filter((F.col("days") >= min_days) & (F.col("peak_views") >= min_peak))
    )
    return published.join(views, "movie_id").join(movies.select("movie_id", "title"), "movie_id")


def pick_pair(candidates: DataFrame) -> DataFrame:
    """The most viewed many-item movie and its best few-item counterpart (role many / few).

    The counterpart comes from the narrowest day-span tolerance that has any;
    each choice is a top-1 against the anchor's two values, never a self pairing.
    """
    by_fame = [F.desc("peak_views"), F.col("movie_id")]
    strict = (F.col("n_items") >= MANY_ITEMS) & (F.col("days") >= MANY_MIN_DAYS)
    anchor = (
        candidates.filter(F.col("n_items") >= MANY_FALLBACK)
        .orderBy(F.desc(strict), *by_fame)
        .limit(1)
    )
    gap = F.abs(F.col("days") - anchor.select("days").scalar())
    tier = F.lit(len(DAY_TOLERANCES))
    for i, tol in reversed(list(enumerate(DAY_TOLERANCES))):
        tier = F.when(gap <= tol, i).otherwise(tier)
    partner = (
        candidates.filter((F.col("n_items") <= FEW_ITEMS) & (F.col("movie_id") != anchor.select("movie_id").scalar()))
        .withColumn("_tier", tier)
        .orderBy("_tier", *by_fame)
        .limit(1)
        .drop("_tier")
    )
    pair = anchor.withColumn("role", F.lit("many")).unionByName(partner.withColumn("role", F.lit("few")))
    # without a counterpart there is no pair
    return pair.filter(pair.agg(F.count("*")).scalar() == 2)


def view_series(
    stats: DataFrame, items: DataFrame, as_of: date | str, chosen: DataFrame
) -> DataFrame:
    """New views of the chosen movies by day since their first observed day."""
    day0 = F.min("collected_date").over(Window.partitionBy("movie_id"))
    # ``chosen`` is a pair of rows; it goes below the counters as an item filter
    ids = F.broadcast(chosen.select("movie_id"))
    own = items.join(ids, "movie_id", "left_semi")
    return (
        movie_days(stats, own, as_of, WINDOW_DAYS, selective=True)
        .filter(F.col("delta_views").isNotNull())
        .select(
            "movie_id", "collected_date",
            F.datediff("collected_date", day0).alias("day"), F.col("delta_views").alias("dv"),
        )
    )


def launch_days(series: DataFrame, items: DataFrame) -> DataFrame:
    """Launches placed on the curve: each snaps to the first observed day on or after it.

    Launches before the first observed day, or after the last one, are left out.
    """
    observed = series.select("movie_id", "collected_date", "day")
    first = observed.groupBy("movie_id").agg(F.min("collected_date").alias("_day0"))
    launches = (
        movie_links(items)
        .filter(F.col("published_at").isNotNull())
        .select("movie_id", F.to_date("published_at").alias("launch"))
        .join(first, "movie_id")
        .filter(F.col("launch") >= F.col("_day0"))
        .select("movie_id", "launch")
        .distinct()
    )
    snapped = next_event(
        launches, observed, ["movie_id"], "launch", "collected_date", ["day"], inclusive=True
    )
    return snapped.filter(F.col("day").isNotNull()).select("movie_id", "day").distinct()


def view_timeseries(
    stats: DataFrame, items: DataFrame, movies: DataFrame, as_of: date | str,
    min_peak: int = MIN_PEAK_VIEWS, min_days: int = MIN_DAYS,
) -> DataFrame:
    """The pair's curves as rows, with a mark on launch days."""
    # one row per movie, then two rows, each read by several branches: settle them once
    candidates = pin(view_candidates(stats, items, movies, as_of, min_peak, min_days))
    pair = pin(pick_pair(candidates))
    series = pin(view_series(stats, items, as_of, pair))
    own = items.join(F.broadcast(pair.select("movie_id")), "movie_id", "left_semi")
    marks = launch_days(series, own).withColumn("launch", F.lit(True))
    # two curves of at most a window's days each
    return (
        series.join(marks, ["movie_id", "day"], "left")
        .join(F.broadcast(pair), "movie_id")
        .select(
            "role", "movie_id",
            F.coalesce("title", F.concat(F.lit("movie "), F.col("movie_id").cast("string"))).alias("title"),
            "n_items", F.col("days").alias("days_tracked"), "day", "dv",
            F.coalesce("launch", F.lit(False)).alias("launch"),
        )
    )
