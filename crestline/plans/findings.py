"""Newsworthy states: four detectors, the best one per movie, the top few overall."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.functions.scalars import day, days_before, percent_text, salience_scale
from crestline.operators.ordering import latest
from crestline.plans.metrics import movie_days, movie_links
from crestline.plans.scores import score_units
from crestline.session import pin

# Detector thresholds.
SPENT_VS_PEAK = 0.25
SURGING_VS_PEAK = 0.80
DUE_MAX_DAYS_TO_RELEASE = 45
DUE_MIN_ITEM_AGE = 10
SURGING_MAX_ITEM_AGE = 10
SLIDE_RATIO = 0.90
FATIGUE_DROP_POINTS = 5.0
RECENT_DAYS = 7
FATIGUE_PEAK_DAYS = 120

# Detectors in the order that decides a tie on salience.
KINDS = ("trailer_due", "surging", "quality_slide", "excitement_fatigue")


def movie_facts(stats: DataFrame, items: DataFrame, as_of: date | str, days: int = 30) -> DataFrame:
    """Velocity and quality per movie over ``days``, and its best single-item day of the long window.

    One pass over the longer of the two windows serves all four detectors.
    """
    daily = movie_days(stats, items, as_of, max(days, FATIGUE_PEAK_DAYS))
    inside = F.col("collected_date") >= days_before(as_of, days)
    recent = F.col("collected_date") > days_before(as_of, RECENT_DAYS)
    ratio = F.try_divide("likes", "views")
    for_fatigue = F.col("collected_date") >= days_before(as_of, FATIGUE_PEAK_DAYS)
    return daily.groupBy("movie_id").agg(
        F.avg(F.when(inside & recent, F.col("delta_views"))).alias("cur_vel"),
        F.max(F.when(inside, F.col("delta_views"))).alias("peak_vel"),
        F.avg(F.when(inside & recent, ratio)).alias("lv_recent"),
        F.avg(F.when(inside & ~recent, ratio)).alias("lv_older"),
        F.max(F.when(for_fatigue, F.col("top_item_delta"))).alias("top_item_delta"),
    )


def movie_scan(facts: DataFrame, items: DataFrame, movies: DataFrame, as_of: date | str) -> DataFrame:
    """The facts of movies with an audience, beside their items and release."""
    published = (
        movie_links(items)
        .filter(F.col("published_at").isNotNull())
        .groupBy("movie_id")
        .agg(
            F.count("*").alias("n_items"),
            F.count_if(F.col("tracking_status") == "active").alias("active_items"),
            F.datediff(day(as_of), F.to_date(F.max("published_at"))).alias("last_item_age_days"),
        )
    )
    return (
        facts.filter(F.col("peak_vel") > 0)
        .join(published, "movie_id")
        .join(movies.select("movie_id", "title", "release_date"), "movie_id")
        .withColumn("days_to_release", F.datediff("release_date", day(as_of)))
        .withColumn("vs_peak", F.col("cur_vel") / F.col("peak_vel"))
        .withColumn("_scale", salience_scale(F.col("peak_vel")))
    )


def _finding(rows: DataFrame, kind: str, headline: Column, salience: Column, **more: Column) -> DataFrame:
    """Candidate rows in the shared shape; metrics a detector lacks stay null."""
    shape = {
        "vs_peak": "double", "peak_daily_views": "bigint", "current_daily_views": "double",
        "days_to_release": "int", "last_item_age_days": "int", "n_items": "bigint",
        "active_items": "bigint", "like_view_recent": "double", "like_view_older": "double",
        "first_excitement": "double", "last_excitement": "double", "excitement_delta": "double",
        "slope_per_item": "double",
    }
    name = F.coalesce("title", F.concat(F.lit("movie "), F.col("movie_id").cast("string")))
    return rows.select(
        F.lit(kind).alias("kind"), F.lit(KINDS.index(kind)).alias("_priority"), "movie_id",
        name.alias("title"), headline.alias("headline"), salience.cast("double").alias("salience"),
        *[more.get(c, F.lit(None)).cast(t).alias(c) for c, t in shape.items()],
    )


def _base() -> dict[str, Column]:
    return {
        "vs_peak": F.col("vs_peak"), "peak_daily_views": F.col("peak_vel"),
        "current_daily_views": F.col("cur_vel"), "days_to_release": F.col("days_to_release"),
        "last_item_age_days": F.col("last_item_age_days"), "n_items": F.col("n_items"),
        "active_items": F.col("active_items"),
    }


def _text(c: str) -> Column:
    # a missing value reads None in a headline
    return F.coalesce(F.col(c).cast("string"), F.lit("None"))


def trailer_due(scan: DataFrame) -> DataFrame:
    """Demand spent, release near, nothing new lately: a launch is likely imminent."""
    d2r = F.col("days_to_release")
    rows = scan.filter(
        (F.col("vs_peak") < SPENT_VS_PEAK)
        & d2r.between(1, DUE_MAX_DAYS_TO_RELEASE)
        & (F.coalesce("last_item_age_days", F.lit(0)) >= DUE_MIN_ITEM_AGE)
    )
    proximity = 1 - d2r / (DUE_MAX_DAYS_TO_RELEASE + 1)
    headline = F.concat(
        _text("title"), F.lit(" opens in "), d2r.cast("string"), F.lit("d; trailer demand spent ("),
        percent_text(F.col("vs_peak")), F.lit(" of peak) — new trailer likely imminent"),
    )
    return _finding(rows, "trailer_due", headline, F.col("_scale") * (1 - F.col("vs_peak")) * proximity, **_base())


def surging(scan: DataFrame) -> DataFrame:
    """View velocity still near its peak shortly after a launch."""
    rows = scan.filter(
        (F.col("vs_peak") >= SURGING_VS_PEAK) & (F.col("last_item_age_days") <= SURGING_MAX_ITEM_AGE)
    )
    headline = F.concat(
        _text("title"), F.lit(" trailer surging — still "), percent_text(F.col("vs_peak")),
        F.lit(" of peak views "), F.col("last_item_age_days").cast("string"), F.lit("d in"),
    )
    return _finding(rows, "surging", headline, F.col("_scale") * F.col("vs_peak"), **_base())


def quality_slide(scan: DataFrame) -> DataFrame:
    """Like/view ratio of the last week well below the time before."""
    recent, older = F.col("lv_recent"), F.col("lv_older")
    rows = scan.filter((recent != 0) & (older != 0) & (recent < older * SLIDE_RATIO))
    drop = 1 - recent / older
    headline = F.concat(
        _text("title"), F.lit(" cooling — like/view down "), percent_text(drop), F.lit(" this week")
    )
    return _finding(
        rows, "quality_slide", headline, F.col("_scale") * drop,
        **_base(), like_view_recent=recent, like_view_older=older,
    )


def excitement_fatigue(sequence: DataFrame, facts: DataFrame, movies: DataFrame) -> DataFrame:
    """Comment excitement falling along the movie's item sequence (unrounded scores)."""
    drop = F.col("first_score") - F.col("last_score")
    falling = score_units(sequence).filter(drop >= FATIGUE_DROP_POINTS)
    peaks = facts.select("movie_id", F.col("top_item_delta").alias("peak_vel"))
    rows = falling.join(peaks, "movie_id", "left").join(movies.select("movie_id", "title"), "movie_id")
    headline = F.concat(
        _text("title"), F.lit(" — comment excitement cooling "),
        F.round("first_score").cast("bigint").cast("string"), F.lit("→"),
        F.round("last_score").cast("bigint").cast("string"),
        F.lit(" across "), F.col("n_items").cast("string"), F.lit(" trailers"),
    )
    return _finding(
        rows, "excitement_fatigue", headline, salience_scale(F.col("peak_vel")) * (drop / 20.0),
        n_items=F.col("n_items"), first_excitement=F.round("first_score", 1),
        last_excitement=F.round("last_score", 1), excitement_delta=F.round(-drop, 1),
        slope_per_item=F.round("slope", 3),
    )


def best_per_movie(candidates: DataFrame) -> DataFrame:
    """The most salient candidate per movie; on a tie the earlier detector stays."""
    return latest(candidates, ["movie_id"], [F.desc("salience"), F.col("_priority")])


def detect_findings(
    stats: DataFrame,
    items: DataFrame,
    movies: DataFrame,
    as_of: date | str,
    sequence: DataFrame | None = None,
    days: int = 30,
    top: int | None = 6,
) -> DataFrame:
    """Top findings over distinct movies; without a score sequence the fourth detector rests.

    The facts, one row per movie, are pinned: every detector reads them, and the
    counters are scanned once.
    """
    facts = pin(movie_facts(stats, items, as_of, days))
    scan = movie_scan(facts, items, movies, as_of)
    candidates = trailer_due(scan).unionByName(surging(scan)).unionByName(quality_slide(scan))
    if sequence is not None:
        candidates = candidates.unionByName(excitement_fatigue(sequence, facts, movies))
    best = best_per_movie(candidates)
    if top is None:
        return best.drop("_priority")
    return best.orderBy(F.desc("salience"), "_priority", "movie_id").limit(top).drop("_priority")


def finding_series(
    findings: DataFrame,
    stats: DataFrame,
    items: DataFrame,
    as_of: date | str,
    sequence: DataFrame | None = None,
    days: int = 30,
) -> DataFrame:
    """The curve behind each finding as rows (movie, kind, day, value).

    New views per day, or for fatigue the score at each item's publishing day.
    """
    chosen = findings.select("movie_id", "kind")
    fatigue = F.col("kind") == "excitement_fatigue"
    own = items.join(chosen, "movie_id", "left_semi")
    daily = movie_days(stats, own, as_of, days, selective=True).select(
        "movie_id", F.col("collected_date").alias("day"), F.col("delta_views").cast("double").alias("dv")
    )
    out = chosen.filter(~fatigue).join(daily, "movie_id")
    if sequence is not None:
        scored = sequence.select(
            "movie_id", F.to_date("published_at").alias("day"), F.col("excitement").alias("dv")
        )
        out = out.unionByName(chosen.filter(fatigue).join(scored, "movie_id"))
    return out
