"""Comparison reports over transcript pairs and window matches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crestline.functions.scalars import jaccard, tokens, window_starts

# Window length and tail margin in seconds.
WINDOW_SECONDS, TAIL_SECONDS = 15, 5


def token_sets(texts: DataFrame, *keep: str) -> DataFrame:
    """``keep`` and ``tokens``, the distinct tokens of ``text`` as 64-bit hashes."""
    hashed = F.transform(tokens(F.col("text")), lambda t: F.xxhash64(t))
    return texts.select(*keep, F.array_distinct(hashed).alias("tokens"))


def pair_similarity(sides: DataFrame, key: str) -> DataFrame:
    """Token-set similarity of the two sides of each key that has both, three decimals.

    ``sides``: key, side (0 or 1), tokens; one row per key and side.
    """
    one = [F.max(F.when(F.col("side") == i, F.col("tokens"))).alias(f"_{i}") for i in (0, 1)]
    both = sides.groupBy(key).agg(*one).filter("_0 is not null and _1 is not null")
    return both.select(key, F.round(jaccard(F.col("_0"), F.col("_1")), 3).alias("similarity"))


def transcript_similarity(one: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Similarity of the two texts of each key, one text per key and frame.

    Texts become distinct tokens before the shuffle, so each is tokenised once and
    repeated words do not travel.
    """
    sides = [token_sets(df, key).withColumn("side", F.lit(i)) for i, df in enumerate((one, other))]
    return pair_similarity(sides[0].unionByName(sides[1]), key)


def neighbour_similarity(texts: DataFrame, key: str) -> DataFrame:
    """Similarity of each text with that of the next key: every text is read and tokenised once."""
    places = F.array(
        F.struct(F.col(key).alias("at"), F.lit(0).alias("side")),
        F.struct((F.col(key) - 1).alias("at"), F.lit(1).alias("side")),
    )
    sides = token_sets(texts, key).select(F.inline(places), "tokens")
    return pair_similarity(sides.withColumnRenamed("at", key), key)


def method_summary(attempts: DataFrame) -> DataFrame:
    """Successes, totals, mean latency and words per method (columns method, success, …)."""
    return attempts.groupBy("method").agg(
        F.count("*").alias("total"),
        F.count_if("success").alias("successes"),
        F.avg("latency_seconds").alias("mean_latency"),
        F.avg(F.when(F.col("success"), F.col("word_count"))).alias("mean_words"),
    )


def item_windows(items: DataFrame) -> DataFrame:
    """Back-to-back windows of each item (columns item_id, duration_seconds)."""
    starts = window_starts(F.col("duration_seconds"), WINDOW_SECONDS, TAIL_SECONDS)
    return items.select(
        "item_id", F.posexplode(starts).alias("window_index", "start_seconds")
    )


def match_report(matches: DataFrame) -> DataFrame:
    """Per method: windows tested and matched, hit rate, items with a hit, mean latency."""
    hit = F.col("success")
    per_item = matches.groupBy("method", "item_id").agg(
        F.count("*").alias("n"), F.count_if(hit).alias("h"), F.sum("latency_seconds").alias("l")
    )
    return per_item.groupBy("method").agg(
        F.sum("n").alias("windows_tested"),
        F.sum("h").alias("windows_matched"),
        (F.sum("h") / F.sum("n") * 100).alias("hit_rate_pct"),
        F.count_if(F.col("h") > 0).alias("items_with_hit"),
        F.count("*").alias("items"),
        (F.sum("l") / F.sum("n")).alias("mean_latency"),
    )


def match_report_by_item(matches: DataFrame) -> DataFrame:
    """Per item and method: windows, hits and distinct (title, artist) pairs found.

    Repeated tracks are folded before counting, so no set of tracks is held in memory.
    """
    track = F.when(F.col("success") & (F.col("title") != ""), F.struct("title", "artist"))
    per_track = matches.groupBy("item_id", "method", track.alias("_track")).agg(
        F.count("*").alias("n"), F.count_if("success").alias("h")
    )
    return per_track.groupBy("item_id", "method").agg(
        F.sum("n").alias("windows"), F.sum("h").alias("hits"), F.count("_track").alias("tracks")
    )


def identified_tracks(matches: DataFrame) -> DataFrame:
    """Each (item, method, title, artist) once, at its first window."""
    at = F.struct("start_seconds", "score")
    return (
        matches.filter("success")
        .groupBy(
            "item_id", "method", F.coalesce("title", F.lit("")).alias("title"),
            F.coalesce("artist", F.lit("")).alias("artist"),
        )
        .agg(F.min(at).alias("_at"))
        .select("item_id", "method", "title", "artist", "_at.start_seconds", "_at.score")
    )
