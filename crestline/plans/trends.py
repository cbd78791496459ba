"""Trend fits: engagement quality, demand, decay across size buckets."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crestline.functions.scalars import day
from crestline.operators.rollup import banded_rollup
from crestline.plans.metrics import counter_deltas, movie_days, movie_links

# Band and demand cut points of the trend classification.
STEADY_BAND = 0.05
MIN_POINTS = 5
HOLDING_VS_PEAK = 0.50
COOLING_VS_PEAK = 0.20
REBOUND_RATIO = 1.25
RECENT_DAYS = 7
MIN_TAIL_POINTS = 4
MIN_FIT_DAYS = 10
ITEM_BUCKETS = (("1", 1, 1), ("2-3", 2, 3), ("4+", 4, None))
DECAY_DAYS = 45


def movie_series(
    stats: DataFrame, items: DataFrame, as_of: date | str, days: int, selective: bool = False
) -> DataFrame:
    """Daily like/view ratio and new views per movie, days with views only."""
    return (
        movie_days(stats, items, as_of, days, selective)
        .filter(F.col("views") > 0)
        .select(
            "movie_id", "collected_date", "likes", "views", "delta_views",
            F.try_divide("likes", "views").alias("like_view_ratio"),
        )
    )


def _with_demand_columns(series: DataFrame) -> DataFrame:
    """Point index, last day, peak and peak index over the days with known new views.

    A movie has one row per day of the window, so these windows stay small.
    """
    own = Window.partitionBy("movie_id")
    so_far = own.orderBy("collected_date")
    dv = F.col("delta_views")
    known = dv.isNotNull()
    return (
        series.withColumn("_idx", F.when(known, F.count("delta_views").over(so_far) - 1))
        .withColumn("_last", F.max(F.when(known, F.col("collected_date"))).over(own))
        .withColumn("_peak", F.max(dv).over(own))
        .withColumn("_first", F.min("collected_date").over(own))
        .withColumn("_peak_idx", F.min(F.when(dv == F.col("_peak"), F.col("_idx"))).over(own))
        .withColumn("_ago", F.datediff("_last", "collected_date"))
        .withColumn("_x", F.datediff("collected_date", "_first").cast("double"))
    )


def _demand_state(points: Column, cur: Column, prior: Column, vs_peak: Column) -> Column:
    rebound = (prior > 0) & (cur > REBOUND_RATIO * prior)
    return (
        F.when(points < MIN_POINTS, "insufficient_data")
        .when(rebound, "rebounding")  # tested before the bands
        .when(vs_peak.isNull(), "unknown")
        .when(vs_peak >= HOLDING_VS_PEAK, "holding")
        .when(vs_peak >= COOLING_VS_PEAK, "cooling")
        .otherwise("spent")
    )


def engagement_trend(
    stats: DataFrame, items: DataFrame, as_of: date | str, days: int = 30, selective: bool = False
) -> DataFrame:
    """Both axes for every movie in ``items``; hand in the items of a few with ``selective``.

    Quality: least-squares fit of the like/view ratio on the day offset.
    Demand: recent new views against the window's peak, with the half-life of a
    log-linear fit over the row index after the peak.
    """
    s = _with_demand_columns(movie_series(stats, items, as_of, days, selective))
    dv, ratio, x = F.col("delta_views").cast("double"), F.col("like_view_ratio"), F.col("_x")
    tail = (F.col("_idx") > F.col("_peak_idx")) & (dv > 0)
    idx = F.col("_idx").cast("double")
    fit_x = F.when(ratio.isNotNull(), x)
    per_movie = s.groupBy("movie_id").agg(
        F.count("*").alias("data_points"),
        F.count("delta_views").alias("_points"),
        F.max(dv).alias("_peak_velocity"),
        F.avg(F.when(F.col("_ago").between(0, RECENT_DAYS - 1), dv)).alias("_cur"),
        F.avg(F.when(F.col("_ago").between(RECENT_DAYS, 2 * RECENT_DAYS - 1), dv)).alias("_prior"),
        F.count_if(tail).alias("_tail"),
        F.regr_slope(F.when(tail, F.ln(dv)), F.when(tail, idx)).alias("_tail_slope"),
        F.regr_slope(ratio, x).alias("_slope"),
        F.regr_intercept(ratio, x).alias("_intercept"),
        F.min(fit_x).alias("_x0"),
        F.max(fit_x).alias("_x1"),
        F.avg(ratio).alias("_mean_ratio"),
    )
    launched = F.datediff(day(as_of), F.to_date("published_at")) <= days
    launches = (
        movie_links(items)
        .groupBy("movie_id")
        .agg(F.count("*").alias("n_items"), F.count_if(launched).alias("new_items_in_window"))
    )
    points = F.coalesce("data_points", F.lit(0))
    demand_known = F.coalesce("_points", F.lit(0)) >= MIN_POINTS
    vs_peak = F.when(F.col("_peak_velocity") > 0, F.col("_cur") / F.col("_peak_velocity"))
    half_life = F.when(
        (F.col("_tail") >= MIN_TAIL_POINTS) & (F.col("_tail_slope") < 0),
        F.lit(0.6931471805599453) / -F.col("_tail_slope"),  # ln 2
    )
    start = F.col("_intercept") + F.col("_slope") * F.col("_x0")
    end = F.col("_intercept") + F.col("_slope") * F.col("_x1")
    fitted = (points >= MIN_POINTS) & F.col("_slope").isNotNull()
    change = F.when(F.col("_start") != 0, (F.col("_end") - F.col("_start")) / F.col("_start")).otherwise(0.0)
    quality = (
        F.when(~F.col("_fitted"), "insufficient_data")
        .when(F.col("_change") > STEADY_BAND, "gaining")
        .when(F.col("_change") < -STEADY_BAND, "losing")
        .otherwise("steady")
    )

    def if_fitted(c: str) -> Column:
        return F.when(F.col("_fitted"), F.col(c))

    return (
        launches.join(per_movie, "movie_id", "left")
        .withColumn("data_points", points)
        .withColumn("_fitted", F.coalesce(fitted, F.lit(False)))
        .withColumn("_start", start)
        .withColumn("_end", end)
        .withColumn("_change", change)
        .withColumn("velocity_vs_peak", F.when(demand_known, vs_peak))
        .withColumn(
            "demand_state",
            _demand_state(F.coalesce("_points", F.lit(0)), F.col("_cur"), F.col("_prior"), F.col("velocity_vs_peak")),
        )
        .withColumn("quality_classification", quality)
        .select(
            "movie_id", "n_items", "new_items_in_window", "data_points", "demand_state",
            F.when(demand_known, F.col("_cur")).alias("current_velocity"),
            F.when(demand_known, F.col("_peak_velocity")).alias("peak_velocity"),
            "velocity_vs_peak",
            F.when(demand_known, half_life).alias("post_peak_half_life_days"),
            "quality_classification",
            if_fitted("_slope").alias("slope_per_day"),
            if_fitted("_change").alias("pct_change_over_window"),
            if_fitted("_start").alias("ratio_start"),
            if_fitted("_end").alias("ratio_end"),
            if_fitted("_mean_ratio").alias("avg_like_view_ratio"),
            F.when(
                F.col("_fitted"),
                F.concat("quality_classification", F.lit(" quality / "), "demand_state", F.lit(" demand")),
            ).otherwise("insufficient_data").alias("verdict"),
        )
    )


def recent_launches(items: DataFrame, as_of: date | str, days: int = 30) -> DataFrame:
    """The items counted in ``new_items_in_window``, one row each."""
    return movie_links(items).filter(
        F.datediff(day(as_of), F.to_date("published_at")) <= days
    ).select(
        "movie_id", "item_id", F.col("name").alias("item_name"), "video_type", "published_at", "tracking_status"
    )


def decay_units(
    stats: DataFrame, items: DataFrame, as_of: date | str, days: int = 45, unit: str = "movie"
) -> DataFrame:
    """Fitted relative change of the like/view ratio over the window, per movie or per item."""
    if unit == "movie":
        base = movie_days(stats, items, as_of, days).select(
            F.col("movie_id").alias("unit_id"), "movie_id", "collected_date", "likes", "views"
        )
    elif unit == "item":
        links = movie_links(items).select("item_id", "movie_id")
        base = (
            counter_deltas(stats, as_of, days, ("view_count", "like_count"))
            .join(links, "item_id")
            .select(
                F.col("item_id").alias("unit_id"), "movie_id", "collected_date",
                F.col("like_count").alias("likes"), F.col("view_count").alias("views"),
            )
        )
    else:
        raise ValueError("unit must be 'movie' or 'item'")
    lv = F.try_divide("likes", "views")
    x = F.datediff("collected_date", day(as_of)).cast("double")
    fit = (
        base.select("unit_id", "movie_id", "views", lv.alias("lv"), x.alias("x"))
        .filter(F.col("lv") > 0)
        .groupBy("unit_id", "movie_id")
        .agg(
            F.count("*").alias("n"),
            F.regr_slope("lv", "x").alias("slope"),
            F.avg("lv").alias("mean_lv"),
            F.avg("x").alias("mean_x"),
            F.min("x").alias("x0"),
            F.max("x").alias("x1"),
            F.max("views").alias("peak_views"),
        )
        .filter((F.col("n") >= MIN_FIT_DAYS) & (F.col("x1") > F.col("x0")) & (F.col("mean_lv") > 0))
    )
    start = F.col("mean_lv") + F.col("slope") * (F.col("x0") - F.col("mean_x"))
    end = F.col("mean_lv") + F.col("slope") * (F.col("x1") - F.col("mean_x"))
    sizes = movie_links(items).groupBy("movie_id").agg(F.count("*").alias("n_items"))
    return (
        fit.join(sizes, "movie_id")
        .withColumn("start", start)
        .withColumn("end", end)
        .filter(F.col("start") > 0)
        .select(
            "unit_id", "movie_id", "n_items", F.coalesce("peak_views", F.lit(0)).alias("weight"),
            ((F.col("end") - F.col("start")) / F.col("start")).alias("pct"),
        )
    )


def engagement_decay(
    stats: DataFrame, items: DataFrame, as_of: date | str, days: int = DECAY_DAYS, unit: str = "movie"
) -> DataFrame:
    """How the like/view ratio moves across units, overall and by the movie's item count."""
    units = decay_units(stats, items, as_of, days, unit).select("pct", "weight", "n_items")
    weighted = F.try_divide(F.sum(F.col("pct") * F.col("weight")), F.sum("weight"))
    rolled = banded_rollup(
        units, "pct", "n_items", ITEM_BUCKETS, STEADY_BAND, [weighted.alias("view_weighted_pct_change")]
    )
    return rolled.select(
        "bucket", "units", F.col("below").alias("losing"), F.col("within").alias("steady"),
        F.col("above").alias("gaining"), F.col("below_share").alias("losing_share"),
        F.col("median").alias("median_pct_change"), "view_weighted_pct_change",
    )
