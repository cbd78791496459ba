"""Read queries over items, counters and comments."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crestline.functions.scalars import days_before, image_url, or_unknown
from crestline.operators.ordering import top_n
from crestline.plans.metrics import counter_deltas, daily_metrics, movie_links
from crestline.session import pin
from crestline.sources.tables import COMMENT_FLOOR_DAYS, COUNTER_FLOOR_DAYS

MAX_ROWS = 100
MAX_COMMENTS = 30
TRENDING_DAYS, CAROUSEL_DAYS, CAROUSEL_SIZE = 7, 30, 10
# Languages whose items the regional report looks at.
REGIONAL_LANGUAGES = ("hi", "ta", "te", "ml", "kn", "pa", "bn", "mr")


#: what ``titled_items`` reads of an item
TITLED = (
    "item_id", "content_kind", "movie_id", "tv_id", "season_number", "name", "video_type", "tracking_status",
    "published_at", "tracking_end_date", "thumbnail_url",
)


def titled_items(
    items: DataFrame, movies: DataFrame, shows: DataFrame, seasons: DataFrame
) -> DataFrame:
    """Items with title, release date, poster and countries from whichever title they hang on.

    No broadcast hints: measured sizes decide at run time, and a title holding
    very many items is split by the adaptive skew join. An item without a movie
    (or show) has nothing to find there, but a null key would still send all
    such items to one task: a salt next to the key spreads them.
    """
    m = movies.select(
        "movie_id", F.col("title").alias("_mt"), F.col("release_date").alias("_md"),
        F.col("poster_path").alias("_mp"), F.col("origin_countries").alias("_mc"),
    )
    tv = shows.select(
        "tv_id", F.col("name").alias("_tt"), F.col("poster_path").alias("_tp"),
        F.col("origin_countries").alias("_tc"),
    )
    se = seasons.select("tv_id", "season_number", F.col("air_date").alias("_sd"))
    named = items.withColumnRenamed("name", "item_name")
    for dim, keys in ((m, ["movie_id"]), (tv, ["tv_id"]), (se, ["tv_id", "season_number"])):
        salted = named.withColumn("_salt", null_salt(F.col(keys[0]), F.col("item_id")))
        named = salted.join(dim.withColumn("_salt", F.lit(0)), [*keys, "_salt"], "left").drop("_salt")
    return named.select(
        "item_id", "content_kind", "movie_id", "tv_id", "season_number", "item_name",
        "video_type", "tracking_status", "published_at", "tracking_end_date", "thumbnail_url",
        F.coalesce("_mt", "_tt").alias("title"),
        F.coalesce("_md", "_sd").alias("release_date"),
        F.coalesce("_mp", "_tp").alias("poster_path"),
        F.coalesce("_mc", "_tc").alias("origin_countries"),
    )


def title_few(
    few: DataFrame, movies: DataFrame, shows: DataFrame, seasons: DataFrame
) -> DataFrame:
    """``titled_items`` for a pinned top list: the titles are cut to its ids before any join.

    ``few`` holds at most ``MAX_ROWS`` items, so its ids are broadcast and the
    title tables are only scanned.
    """

    def own(dim: DataFrame, key: str) -> DataFrame:
        return dim.join(F.broadcast(few.select(key)), key, "left_semi")

    return titled_items(few, own(movies, "movie_id"), own(shows, "tv_id"), own(seasons, "tv_id"))


def null_salt(key: Column, row_id: Column, parts: int = 1024) -> Column:
    """0 next to a real key; next to a null one a number that scatters the rows."""
    return F.when(key.isNull(), F.pmod(F.xxhash64(row_id), F.lit(parts))).otherwise(0).cast("int")


def _title_filter(kind: str | None, country: str | None) -> Column:
    keep = F.lit(True)
    if kind:
        keep = keep & (F.col("content_kind") == kind)
    if country:
        keep = keep & F.array_contains("origin_countries", country)
    return keep


def titled_where(
    items: DataFrame, movies: DataFrame, shows: DataFrame, seasons: DataFrame,
    content_kind: str | None = None, country: str | None = None, text: str | None = None,
) -> DataFrame:
    """``titled_items`` of the titles from one country or with a text in their name.

    The title tables are cut first, and items to the titles that are left, before any item is joined.
    """
    kept = items.filter(_title_filter(content_kind, None))
    if not (country or text):
        return titled_items(kept, movies, shows, seasons)
    pattern = f"%{text.lower()}%" if text else None

    def cut(titles: DataFrame, name: str) -> DataFrame:
        if country:
            titles = titles.filter(F.array_contains("origin_countries", country))
        return titles.filter(F.lower(name).like(pattern)) if text else titles

    m, s = cut(movies, "title"), cut(shows, "name")
    of_movies = kept.join(m.select("movie_id"), "movie_id", "left_semi")
    of_shows = kept.filter(F.col("movie_id").isNull()).join(s.select("tv_id"), "tv_id", "left_semi")
    return titled_items(of_movies.unionByName(of_shows), m, s, seasons)


def search_items(
    titled: DataFrame,
    content_kind: str | None = None,
    country: str | None = None,
    tracking_status: str | None = "active",
    query_text: str | None = None,
    limit: int = 25,
) -> DataFrame:
    """Titled items by kind, country, state and title text, newest first.

    ``%`` and ``_`` in the text act as wildcards.
    """
    keep = _title_filter(content_kind, country)
    if tracking_status:
        keep = keep & (F.col("tracking_status") == tracking_status)
    if query_text:
        keep = keep & F.lower("title").like(f"%{query_text.lower()}%")
    return (
        titled.filter(keep)
        .withColumn("poster_url", image_url(F.col("poster_path")))
        .orderBy(F.desc("published_at"), "item_id")
        .limit(min(limit, MAX_ROWS))
    )


def find_items(
    items: DataFrame, movies: DataFrame, shows: DataFrame, seasons: DataFrame,
    content_kind: str | None = None, country: str | None = None, tracking_status: str | None = "active",
    query_text: str | None = None, limit: int = 25,
) -> DataFrame:
    """``search_items`` over the tables themselves: every filter is applied below the joins."""
    if tracking_status:
        items = items.filter(F.col("tracking_status") == tracking_status)
    titled = titled_where(items, movies, shows, seasons, content_kind, country, query_text)
    return search_items(titled, tracking_status=None, limit=limit)


def item_metrics(
    stats: DataFrame, items: DataFrame, as_of: date | str, item_id: str | Column, days: int = 30
) -> DataFrame:
    """Daily metrics of one item (an id, or a scalar subquery giving it); the filter reaches both scans."""
    own = F.col("item_id") == item_id
    return daily_metrics(stats.filter(own), items.filter(own), as_of, since=days).orderBy("collected_date")


def top_comments(
    comments: DataFrame,
    as_of: date | str,
    item_id: str | None = None,
    snapshot_kind: str | None = None,
    limit: int = MAX_COMMENTS,
) -> DataFrame:
    """Best-ranked comments per item, from its latest snapshot or from one snapshot kind.

    Ordering by (newest snapshot, rank) puts the latest snapshot's comments
    first, so one bounded row-number pass finds both the snapshot and its top.
    """
    rows = comments.filter(F.col("snapshot_date") >= days_before(as_of, COMMENT_FLOOR_DAYS))
    if item_id is not None:
        rows = rows.filter(F.col("item_id") == item_id)
    n = min(limit, MAX_COMMENTS)
    if snapshot_kind:
        order = [F.col("rank"), F.col("comment_id")]
        return top_n(rows.filter(F.col("snapshot_kind") == snapshot_kind), ["item_id"], order, n, "position")
    order = [F.desc("snapshot_date"), F.col("rank"), F.col("comment_id")]
    newest = top_n(rows, ["item_id"], order, n, "position")
    first_date = F.max("snapshot_date").over(Window.partitionBy("item_id"))
    return (
        newest.withColumn("_newest", first_date)
        .filter(F.col("snapshot_date") == F.col("_newest"))
        .drop("_newest")
    )


def growth(stats: DataFrame, as_of: date | str, period_days: int) -> DataFrame:
    """New views and likes per item over the period."""
    return (
        counter_deltas(stats, as_of, period_days, ("view_count", "like_count"))
        .groupBy("item_id")
        .agg(
            F.sum("delta_views").alias("views_gained"),
            F.sum("delta_likes").alias("likes_gained"),
            F.max("view_count").alias("view_count"),
            F.avg(F.try_divide("like_count", "view_count")).alias("avg_like_view_ratio"),
        )
        .filter(F.col("views_gained").isNotNull())
    )


def trending(
    stats: DataFrame,
    items: DataFrame,
    movies: DataFrame,
    shows: DataFrame,
    seasons: DataFrame,
    as_of: date | str,
    period_days: int = TRENDING_DAYS,
    content_kind: str | None = None,
    country: str | None = None,
    limit: int = 20,
) -> DataFrame:
    """Items with the largest view growth over the period.

    Titles are resolved for the winners only, unless a country, which is known
    from the title alone, takes part in the choice.
    """
    gains = growth(stats, as_of, period_days)
    by_gain = [F.desc("views_gained"), F.col("item_id")]
    n = min(limit, MAX_ROWS)
    if country:
        titled = titled_where(items, movies, shows, seasons, content_kind, country)
        winners = gains.join(titled, "item_id").orderBy(*by_gain).limit(n)
    else:
        kept = items.filter(_title_filter(content_kind, None)).select(*TITLED)
        top = pin(gains.join(kept, "item_id").orderBy(*by_gain).limit(n))  # at most MAX_ROWS rows
        titled = title_few(top.select(*TITLED), movies, shows, seasons)
        winners = F.broadcast(top.select(*gains.columns)).join(titled, "item_id")
    return winners.select(
        "item_id", "content_kind", "title", "item_name", "tracking_status", "release_date",
        "origin_countries", "poster_path", "views_gained", "likes_gained", "view_count",
        "avg_like_view_ratio", image_url(F.col("poster_path")).alias("poster_url"),
    ).orderBy(*by_gain)


def carousel(
    stats: DataFrame, items: DataFrame, movies: DataFrame, shows: DataFrame, seasons: DataFrame,
    as_of: date | str,
) -> DataFrame:
    """The month's top items; those without a poster drop out of the ten afterwards."""
    return (
        trending(stats, items, movies, shows, seasons, as_of, CAROUSEL_DAYS, limit=CAROUSEL_SIZE)
        .filter(F.col("poster_url").isNotNull())
        .select(
            "item_id", "title", "poster_url", "views_gained", "likes_gained", "view_count",
            "release_date", "content_kind",
        )
    )


def country_stats(items: DataFrame, movies: DataFrame, shows: DataFrame) -> DataFrame:
    """Item counts per origin country; an item counts once for each of its countries.

    Counters are summed per title before the titles are joined, so a title with
    very many items reaches the join as one row.
    """
    state = F.col("tracking_status")
    per_title = items.groupBy("movie_id", "tv_id").agg(
        F.count("*").alias("total_items"),
        F.count_if(state == "active").alias("active_items"),
        F.count_if(state == "ended").alias("ended_items"),
        F.count_if(state == "unavailable").alias("unavailable_items"),
        F.count_if(F.col("transcript_captured_at").isNotNull()).alias("with_transcript"),
        F.count_if(
            F.col("comments_at_discovery_captured_at").isNotNull()
            | F.col("comments_pre_release_captured_at").isNotNull()
        ).alias("with_comments"),
    )
    sums = [c for c in per_title.columns if c not in {"movie_id", "tv_id"}]
    # an empty movie list does not fall back to the show's list
    countries = F.coalesce("_mc", "_tc")
    # titles without the key of a join go around it, so null keys never meet in one task
    none = F.lit(None).cast("array<string>")
    of_movie = F.col("movie_id").isNotNull()
    with_movie = per_title.filter(of_movie).join(
        movies.select("movie_id", F.col("origin_countries").alias("_mc")), "movie_id", "left"
    ).unionByName(per_title.filter(~of_movie).withColumn("_mc", none))
    of_show = F.col("_mc").isNull() & F.col("tv_id").isNotNull()
    with_both = with_movie.filter(of_show).join(
        shows.select("tv_id", F.col("origin_countries").alias("_tc")), "tv_id", "left"
    ).unionByName(with_movie.filter(~of_show).withColumn("_tc", none))
    return (
        with_both.select(F.explode(or_unknown(countries)).alias("country"), *sums)
        .groupBy("country")
        .agg(*[F.sum(c).alias(c) for c in sums])
    )


def coverage(countries: DataFrame, items: DataFrame) -> DataFrame:
    """Headline totals: sums include UNKNOWN, the country count does not."""
    totals = countries.agg(
        F.count_if(F.col("country") != "UNKNOWN").alias("countries_covered"),
        *[
            F.coalesce(F.sum(src), F.lit(0)).alias(dst)
            for src, dst in (
                ("total_items", "total_attributions"),
                ("active_items", "active_items"),
                ("with_comments", "with_comments"),
                ("with_transcript", "with_transcript"),
            )
        ],
    )
    size = items.agg(F.count("*").alias("unique_items"))
    # one row each; stacked and folded into one
    both = size.unionByName(totals, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


def top_countries(countries: DataFrame, n: int = 8) -> DataFrame:
    return (
        countries.filter(F.col("country") != "UNKNOWN")
        .select("country", "total_items")
        .orderBy(F.desc("total_items"), "country")
        .limit(n)
    )


def coverage_document(countries: DataFrame, items: DataFrame, n: int = 8) -> DataFrame:
    """The headline totals with the countries that have most items, first ones first."""
    few = top_countries(countries, n)  # n rows
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("total_items")).alias("o"), "country", "total_items")))
    listed = few.agg(F.transform(ranked, lambda c: F.struct(c["country"].alias("country"), c["total_items"].alias("total_items"))).alias("t"))
    return coverage(countries, items).withColumn("top_countries", listed.scalar())


def representative_item(comments: DataFrame, items: DataFrame, as_of: date | str) -> DataFrame:
    """The movie item with the most discovery comments (the lowest id on a tie)."""
    counts = (
        comments.filter(
            (F.col("snapshot_date") >= days_before(as_of, COMMENT_FLOOR_DAYS))
            & (F.col("snapshot_kind") == "at_discovery")
        )
        .groupBy("item_id")
        .agg(F.count("*").alias("n_comments"))
    )
    return (
        counts.join(movie_links(items).select("item_id", "movie_id"), "item_id")
        .orderBy(F.desc("n_comments"), "item_id")
        .limit(1)
    )


def latest_counters(stats: DataFrame, as_of: date | str) -> DataFrame:
    """Newest snapshot per item."""
    rows = stats.filter(F.col("collected_date") >= days_before(as_of, COUNTER_FLOOR_DAYS))
    return rows.groupBy("item_id").agg(
        F.max("collected_date").alias("collected_date"),
        F.max_by("view_count", "collected_date").alias("view_count"),
    )


def regional_candidates(
    items: DataFrame,
    movies: DataFrame,
    stats: DataFrame,
    as_of: date | str,
    min_duration: int = 45,
    country: str = "IN",
    limit: int = 10,
) -> DataFrame:
    """Most-viewed long enough items of regional-language movies, by latest counters."""
    chosen = movies.filter(
        F.col("original_language").isin(*REGIONAL_LANGUAGES)
        | F.array_contains("origin_countries", country)
    ).select("movie_id", F.col("title").alias("movie_title"), "original_language")
    candidates = items.filter(
        (F.col("content_kind") == "movie") & (F.col("duration_seconds") >= min_duration)
    )
    wanted = candidates.join(chosen, "movie_id")
    # the candidates' counters only: the history of all other items is not aggregated
    own = stats.join(wanted.select("item_id"), "item_id", "left_semi")
    return (
        wanted.join(latest_counters(own, as_of).drop("collected_date"), "item_id", "left")
        .select(
            "item_id", "movie_title", "original_language", "video_type",
            F.col("name").alias("item_name"), "channel_title", "duration_seconds",
            F.coalesce("view_count", F.lit(0)).alias("view_count"),
        )
        .orderBy(F.desc("view_count"), "item_id")
        .limit(limit)
    )
