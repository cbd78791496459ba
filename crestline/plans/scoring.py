"""Scoring comment sections: pooled features, linear head, versioned job."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crestline.functions.lexicon import hype_points
from crestline.functions.scalars import day, days_before, is_safe_id, strip_ws
from crestline.operators.ordering import top_n
from crestline.operators.upsert import upsert
from crestline.schemas import TABLES
from crestline.sources.tables import COUNTER_FLOOR_DAYS

TOP_COMMENTS = 30  # fixed value: comments pooled per item
AUX_FEATURES = 3  # log mean like, log count, hype rate


@dataclass(frozen=True)
class LinearHead:
    """Standardise, weigh, add the intercept. ``layout`` names the feature recipe."""

    version: str
    coef: Sequence[float]
    intercept: float
    mean: Sequence[float]
    scale: Sequence[float]
    layout: str

    def check(self, layout: str) -> None:
        if layout != self.layout:
            raise ValueError(f"head expects {self.layout!r}, features are {layout!r}")


HEAD_DDL = "version string, coef array<double>, intercept double, mean array<double>, scale array<double>, layout string"


def save_head(spark: SparkSession, head: LinearHead, path: str) -> None:
    """The head as a table of one row at ``path``; an earlier one is replaced."""
    row = (
        head.version, [float(x) for x in head.coef], float(head.intercept), [float(x) for x in head.mean],
        [float(x) for x in head.scale], head.layout,
    )
    spark.createDataFrame([row], HEAD_DDL).repartition(1).write.mode("overwrite").parquet(path)


def load_head(spark: SparkSession, path: str, layout: str) -> LinearHead:
    """The head saved at ``path``, if it was trained on features of ``layout``."""
    rows = spark.read.schema(HEAD_DDL).parquet(path).take(2)
    if len(rows) != 1:
        raise ValueError(f"expected one head at {path}")
    head = LinearHead(*rows[0])
    head.check(layout)
    sizes = {len(head.coef), len(head.mean), len(head.scale)}
    if len(sizes) != 1:
        raise ValueError(f"the head at {path} has parts of different length")
    return head


def feature_layout(dim: int) -> str:
    return f"emb{dim}+log_mean_like+log_n+lexicon"


def discovery_comments(comments: DataFrame, as_of: date | str) -> DataFrame:
    return comments.filter(
        (F.col("snapshot_kind") == "at_discovery")
        & (F.col("snapshot_date") >= days_before(as_of, COUNTER_FLOOR_DAYS))
    )


def unscored_items(comments: DataFrame, scores: DataFrame, version: str, as_of: date | str) -> DataFrame:
    """Items with discovery comments but no score of this version yet."""
    floor = days_before(as_of, COUNTER_FLOOR_DAYS)
    done = scores.filter((F.col("scored_date") >= floor) & (F.col("model_version") == version))
    have = discovery_comments(comments, as_of).select("item_id").distinct()
    return have.join(done.select("item_id"), "item_id", "left_anti").filter(is_safe_id(F.col("item_id")))


def by_rank() -> list[Column]:
    """Best rank first; a missing or zero rank comes last."""
    rank = F.coalesce(F.when(F.col("rank") != 0, F.col("rank")), F.lit(1_000_000))
    return [rank, F.col("comment_id")]


def comment_sets(comments: DataFrame) -> DataFrame:
    """Per item the top comments as one array, plus totals over all its comments."""
    texts = comments.filter(F.col("text").isNotNull())
    top = (
        top_n(texts, ["item_id"], [F.col("rank"), F.col("comment_id")], TOP_COMMENTS)
        .groupBy("item_id")
        .agg(
            F.array_sort(F.collect_list(F.struct("_rn", "text", "like_count", "rank"))).alias("comments")
        )
    )
    totals = texts.groupBy("item_id").agg(
        F.count("*").alias("n_comments"),
        F.avg("like_count").alias("mean_like_count"),
        F.max("snapshot_date").alias("source_snapshot_date"),
    )
    return totals.join(top, "item_id")


def pooled_features(comments: DataFrame, embedding: str = "embedding") -> DataFrame:
    """One feature array per item with usable text.

    ``comments`` carries a vector per comment. The best 30 by rank are kept,
    blank texts dropped, and vectors averaged with weight log1p(likes) — equally
    when no comment has likes. Three auxiliary features follow.
    """
    top = top_n(comments, ["item_id"], by_rank(), TOP_COMMENTS).withColumn("_text", strip_ws(F.col("text")))
    likes = F.greatest(F.coalesce("like_count", F.lit(0)), F.lit(0)).cast("double")
    own = Window.partitionBy("item_id")  # at most 30 rows
    kept = (
        top.filter(F.col("_text") != "")
        .withColumn("_likes", likes)
        .withColumn("_w", F.log1p("_likes"))
        .withColumn("_w", F.when(F.sum("_w").over(own) > 0, F.col("_w")).otherwise(1.0))
    )
    vec = array_to_vector(F.col(embedding).cast("array<double>"))
    pooled = kept.groupBy("item_id").agg(
        Summarizer.mean(vec, F.col("_w")).alias("_mean"),
        F.log1p(F.avg("_likes")).alias("log_mean_like"),
        F.log1p(F.count("*").cast("double")).alias("log_n"),
        F.avg(hype_points(F.col("_text"))).alias("lexicon"),
    )
    aux = F.array("log_mean_like", "log_n", "lexicon")
    return pooled.select("item_id", F.concat(vector_to_array("_mean"), aux).alias("features"))


def lexicon_rates(comments: DataFrame) -> DataFrame:
    """The hype signal alone: mean points over the best 30 comments of an item."""
    top = top_n(comments, ["item_id"], by_rank(), TOP_COMMENTS)
    return top.groupBy("item_id").agg(F.avg(hype_points(F.col("text"))).alias("lexicon"))


def linear_scores(features: DataFrame, head: LinearHead, out: str = "excitement") -> DataFrame:
    """Head output clipped to 0..100; null features give a null score.

    Standardising is folded into one weight per feature and one constant.
    """
    weights = [c / s for c, s in zip(head.coef, head.scale, strict=True)]
    constant = head.intercept - sum(w * m for w, m in zip(weights, head.mean, strict=True))
    terms = F.zip_with("features", F.array(*[F.lit(w) for w in weights]), lambda x, w: x * w)
    dot = F.aggregate(terms, F.lit(float(constant)), lambda acc, t: acc + t)
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(100.0), dot))  # both skip nulls
    return features.withColumn(out, F.when(F.col("features").isNotNull(), clipped))


def candidate_scores(
    comments: DataFrame,
    scores: DataFrame,
    head: LinearHead,
    today: date | str,
    now: Column,
    dim: int,
    limit: int | None = None,
) -> DataFrame:
    """Rows for items this version has not scored; without usable text the score is null and the item is skipped."""
    head.check(feature_layout(dim))
    targets = unscored_items(comments, scores, head.version, today)
    if limit:
        targets = targets.orderBy("item_id").limit(limit)
    own = discovery_comments(comments, today).filter(F.col("text").isNotNull())
    own = own.join(targets, "item_id", "left_semi")
    totals = own.groupBy("item_id").agg(
        F.count("*").alias("n_comments"),
        F.avg("like_count").alias("mean_like_count"),
        F.max("snapshot_date").alias("source_snapshot_date"),
    )
    found = linear_scores(pooled_features(own), head).select("item_id", "excitement")
    return totals.join(found, "item_id", "left").select(
        "item_id", F.lit(head.version).alias("model_version"), day(today).alias("scored_date"),
        F.round("excitement", 2).alias("excitement"), F.lit("at_discovery").alias("snapshot_kind"),
        "n_comments", "mean_like_count", "source_snapshot_date", now.alias("created_at"),
    )


def score_run(
    comments: DataFrame,
    scores: DataFrame,
    head: LinearHead,
    today: date | str,
    now: Column,
    dim: int,
    limit: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(new score rows, score table after the merge) for items this version has not scored."""
    scored = candidate_scores(comments, scores, head, today, now, dim, limit).filter(F.col("excitement").isNotNull())
    spec = TABLES["scores"]
    return scored, upsert(scores, scored, spec.keys, within=F.col(spec.partition) == day(today))
