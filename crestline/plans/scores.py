"""Model scores along a movie's item sequence."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.operators.rollup import banded_rollup
from crestline.plans.metrics import current_sequence
from crestline.session import pin

# A change within two points counts as steady; bucket edges by scored items.
STEADY_POINTS = 2.0
SCORE_BUCKETS = (("2", 2, 2), ("3-4", 3, 4), ("5+", 5, None))
EXAMPLES = 3

COOLING = "cooling — later trailers draw less-excited comments"
WARMING = "warming — later trailers draw more-excited comments"
STEADY = "steady excitement across trailers"


def score_units(sequence: DataFrame, value: str = "excitement", by: Sequence[str] = ("movie_id",)) -> DataFrame:
    """Per movie with at least two scored items: slope on the ordinal, first and last score."""
    x = F.col("item_ordinal")
    return (
        sequence.groupBy(*by)
        .agg(
            F.count("*").alias("n_items"),
            F.regr_slope(F.col(value), x.cast("double")).alias("slope"),
            F.min_by(value, x).alias("first_score"),
            F.max_by(value, x).alias("last_score"),
        )
        .filter(F.col("n_items") >= 2)
        .withColumn("delta", F.col("last_score") - F.col("first_score"))
    )


def score_decay(sequence: DataFrame) -> DataFrame:
    """First-to-last change across movies, overall and by number of scored items."""
    rolled = banded_rollup(
        score_units(sequence).select("delta", "slope", "n_items"),
        "delta", "n_items", SCORE_BUCKETS, STEADY_POINTS,
        [F.avg(F.coalesce("slope", F.lit(0.0))).alias("mean_slope")],
    )
    return rolled.select(
        "bucket", F.col("units").alias("movies"), F.col("below").alias("declining"),
        F.col("within").alias("steady"), F.col("above").alias("rising"),
        F.col("below_share").alias("declining_share"),
        F.round("median", 2).alias("median_first_last_delta"),
        F.round("mean_slope", 3).alias("mean_slope_per_item"),
    )


def _verdict(delta: Column) -> Column:
    return (
        F.when(delta < -STEADY_POINTS, COOLING).when(delta > STEADY_POINTS, WARMING).otherwise(STEADY)
    )


def score_trend(sequence: DataFrame) -> DataFrame:
    """Per movie: change and slope of the *rounded* scores, with a verdict from two items on.

    The ordered items themselves are the rows of ``sequence``; they are not
    gathered into one row per movie.
    """
    rounded = sequence.withColumn("_r", F.round("excitement", 2))
    x = F.col("item_ordinal")
    agg = rounded.groupBy("movie_id", "model_version").agg(
        F.count("*").alias("n_items"),
        (F.max_by("_r", x) - F.min_by("_r", x)).alias("_delta"),
        F.regr_slope(F.col("_r"), x.cast("double")).alias("_slope"),
    )
    many = F.col("n_items") >= 2
    return agg.select(
        "movie_id", "model_version", "n_items",
        F.when(many, F.round("_delta", 2)).alias("first_last_delta"),
        F.when(many, F.round("_slope", 3)).alias("slope_per_item"),
        F.when(many, _verdict(F.col("_delta"))).alias("verdict"),
    )


def example_movies(sequence: DataFrame, want: int = EXAMPLES) -> DataFrame:
    """The movies with the most scored items, at least two each."""
    return (
        sequence.groupBy("movie_id")
        .agg(F.count("*").alias("n_items"))
        .filter(F.col("n_items") >= 2)
        .orderBy(F.desc("n_items"), "movie_id")
        .limit(want)
    )


def score_examples(
    scores: DataFrame, items: DataFrame, movies: DataFrame, as_of: date | str,
    version: str | None = None, want: int = EXAMPLES,
) -> DataFrame:
    """Item rows of the example movies with each movie's trend beside them.

    The choice needs counts only; the sequence is built for the chosen movies.
    """
    sequence = current_sequence(scores, items, as_of, version)
    chosen = F.broadcast(pin(example_movies(sequence, want).select("movie_id")))  # ``want`` rows
    own = current_sequence(scores, items.join(chosen, "movie_id", "left_semi"), as_of, version)
    trend = F.broadcast(score_trend(own))  # one row per chosen movie
    titles = F.broadcast(movies.select("movie_id", "title").join(chosen, "movie_id", "left_semi"))
    return (
        own.join(trend.drop("n_items"), ["movie_id", "model_version"])
        .join(titles, "movie_id", "left")
        .select(
            "movie_id",
            F.coalesce("title", F.concat(F.lit("movie "), F.col("movie_id").cast("string"))).alias("title"),
            "n_items", "first_last_delta", "slope_per_item", "verdict", "item_ordinal",
            F.round("excitement", 2).alias("excitement"), "published_at",
        )
    )
