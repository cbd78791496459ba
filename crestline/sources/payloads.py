"""Flattening nested API documents into table rows.

Each document is parsed with an explicit schema and reshaped with array
expressions inside its own row; explodes are the only row-count changes, so
none of this shuffles.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crestline.functions import scalars as fn
from crestline.schemas import COMPANY, GENRE, LANGUAGE, PROVIDER_KINDS

# How many cast members are kept, and which crew jobs.
TOP_CAST = 10
KEY_CREW_JOBS = ("Director", "Writer", "Screenplay", "Producer", "Executive Producer", "Creator")

_THUMB = "struct<url:string>"
VIDEO_STATS = (
    "struct<id:string,"
    "statistics:struct<viewCount:string,likeCount:string,commentCount:string,favoriteCount:string>,"
    "snippet:struct<channelId:string,channelTitle:string,description:string,"
    f"thumbnails:struct<maxres:{_THUMB},standard:{_THUMB},high:{_THUMB},medium:{_THUMB},`default`:{_THUMB}>>,"
    "contentDetails:struct<duration:string,definition:string,regionRestriction:struct<blocked:array<string>>>,"
    "status:struct<embeddable:boolean>>"
)
COMMENT_THREADS = (
    "array<struct<id:string,snippet:struct<totalReplyCount:string,topLevelComment:struct<snippet:struct<"
    "textDisplay:string,textOriginal:string,likeCount:string,authorChannelId:struct<value:string>,"
    "authorDisplayName:string,publishedAt:string,updatedAt:string>>>>>"
)
VIDEOS = (
    "array<struct<key:string,site:string,type:string,name:string,published_at:string,official:boolean>>"
)
_OFFER = "struct<provider_id:bigint,provider_name:string,logo_path:string,display_priority:bigint>"
_REGION = "struct<link:string," + ",".join(f"{k}:array<{_OFFER}>" for k in PROVIDER_KINDS) + ">"
_PROVIDERS = f"`watch/providers`:struct<results:map<string,{_REGION}>>"
_CAST = "struct<id:bigint,name:string,character:string,profile_path:string,`order`:bigint>"
_CREW = "struct<id:bigint,name:string,job:string,department:string,profile_path:string>"
_CREDITS = f"credits:struct<cast:array<{_CAST}>,crew:array<{_CREW}>>"
_SHARED = (
    f"original_language:string,status:string,popularity:double,genres:array<{GENRE}>,"
    "poster_path:string,backdrop_path:string,overview:string,tagline:string,homepage:string,"
    f"production_companies:array<{COMPANY}>,spoken_languages:array<{LANGUAGE}>,"
    "origin_country:array<string>,production_countries:array<struct<iso_3166_1:string>>,"
    f"{_PROVIDERS},{_CREDITS}"
)
MOVIE_DETAILS = (
    f"struct<imdb_id:string,title:string,original_title:string,release_date:string,runtime:bigint,{_SHARED}>"
)
_SEASON = (
    "struct<season_number:bigint,name:string,air_date:string,episode_count:bigint,"
    "overview:string,poster_path:string>"
)
SHOW_DETAILS = (
    "struct<name:string,original_name:string,first_air_date:string,vote_average:double,vote_count:bigint,"
    f"networks:array<{COMPANY}>,seasons:array<{_SEASON}>,{_SHARED}>"
)
SEASON_VIDEOS = f"array<struct<season_number:bigint,videos:{VIDEOS}>>"


def parse(df: DataFrame, col: str, schema: str, out: str) -> DataFrame:
    return df.withColumn(out, F.from_json(col, schema))


# --- counter payloads ---------------------------------------------------------


#: attributes of an item that its statistics document carries
REGISTRY = (
    "channel_id", "channel_title", "thumbnail_url", "description", "duration_seconds", "definition",
    "embeddable", "region_blocked", "last_collected_at",
)


def _video(payload: Column) -> Column:
    """The document as a struct; null unless the whole text is one object."""
    one = F.from_json(F.concat(F.lit("["), payload, F.lit("]")), f"array<{VIDEO_STATS}>")
    return F.when(F.size(one) == 1, F.get(one, F.lit(0)))


def reject_reason(item_id: Column, video: Column) -> Column:
    """Why a video document is not booked under the item it was asked for; null if it is."""
    named = F.coalesce(video["id"], F.lit(""))
    return F.when(named == "", "unreadable").when(named != item_id, "other_id")


def _counters(v: str, collected_date: date | str, now: Column) -> list[Column]:
    """Counters arrive as text."""
    return [
        fn.day(collected_date).alias("collected_date"),
        *[
            fn.safe_int(F.col(f"{v}.statistics.{kind}Count")).alias(f"{kind}_count")
            for kind in ("view", "like", "comment", "favorite")
        ],
        now.alias("collected_at"),
    ]


def _registry(v: str, now: Column) -> list[Column]:
    return [
        F.col(f"{v}.snippet.channelId").alias("channel_id"),
        F.col(f"{v}.snippet.channelTitle").alias("channel_title"),
        fn.pick_thumbnail(f"{v}.snippet.thumbnails").alias("thumbnail_url"),
        F.col(f"{v}.snippet.description").alias("description"),
        fn.duration_seconds(F.col(f"{v}.contentDetails.duration")).alias("duration_seconds"),
        F.col(f"{v}.contentDetails.definition").alias("definition"),
        F.col(f"{v}.status.embeddable").alias("embeddable"),
        F.coalesce(f"{v}.contentDetails.regionRestriction.blocked", F.array().cast("array<string>")).alias("region_blocked"),
        now.alias("last_collected_at"),
    ]


def counter_rows(payloads: DataFrame, collected_date: date | str, now: Column) -> DataFrame:
    """Counter snapshots from raw video documents (columns ``item_id, payload``)."""
    v = payloads.withColumn("v", _video(F.col("payload")))
    return v.select("item_id", *_counters("v", collected_date, now))


def registry_patch(payloads: DataFrame, now: Column) -> DataFrame:
    """Item attributes carried by the same documents."""
    v = payloads.withColumn("v", _video(F.col("payload")))
    return v.select("item_id", *_registry("v", now))


def video_rows(payloads: DataFrame, collected_date: date | str, now: Column) -> DataFrame:
    """All that the documents (columns ``item_id, payload``) say, each parsed once: a row per item, and one per reject.

    ``reason`` is null on rows with counters and attributes, of several documents for one
    item from the one with the greatest payload. Rejects carry their reason and payload.
    """
    judged = payloads.withColumn("v", _video(F.col("payload"))).withColumn("reason", reject_reason(F.col("item_id"), F.col("v")))
    good = F.col("reason").isNull()
    best = F.row_number().over(Window.partitionBy("item_id", good).orderBy(F.desc("payload")))
    return judged.withColumn("_place", best).filter(~good | (F.col("_place") == 1)).select(
        "item_id", "reason", F.when(~good, F.coalesce("payload", F.lit(""))).alias("payload"),
        *_counters("v", collected_date, now), *_registry("v", now),
    )


def reject_rows(rejected: DataFrame, phase: str, today: date | str, now: Column) -> DataFrame:
    """Rows of the rejects table from frames with ``item_id, reason, payload``; equal documents are one row."""
    return rejected.select(
        F.lit(phase).alias("phase"), "item_id", "reason", F.sha2("payload", 256).alias("content_key"), "payload",
        fn.day(today).alias("rejected_date"), now.alias("rejected_at"),
    ).dropDuplicates(["phase", "item_id", "content_key"])


def comment_rows(threads: DataFrame, snapshot_date: date | str, now: Column) -> DataFrame:
    """Ranked comments from thread documents (columns item_id, snapshot_kind, payload).

    The rank is the position in the document.
    """
    rows = parse(threads, "payload", COMMENT_THREADS, "t").select(
        "item_id", "snapshot_kind", F.posexplode("t").alias("pos", "c")
    )
    top = "c.snippet.topLevelComment.snippet"
    return rows.select(
        "item_id",
        "snapshot_kind",
        fn.day(snapshot_date).alias("snapshot_date"),
        F.col("c.id").alias("comment_id"),
        F.coalesce(
            fn.blank_to_null(F.col(f"{top}.textDisplay")), F.col(f"{top}.textOriginal")
        ).alias("text"),
        fn.safe_int(F.col(f"{top}.likeCount")).alias("like_count"),
        fn.safe_int(F.col("c.snippet.totalReplyCount")).alias("total_reply_count"),
        F.col(f"{top}.authorChannelId.value").alias("author_channel_id"),
        F.col(f"{top}.authorDisplayName").alias("author_display_name"),
        fn.iso_timestamp(F.col(f"{top}.publishedAt")).alias("published_at"),
        fn.iso_timestamp(F.col(f"{top}.updatedAt")).alias("updated_at"),
        (F.col("pos") + 1).cast("bigint").alias("rank"),
        now.alias("collected_at"),
    )


# --- title payloads -----------------------------------------------------------


def provider_rows(titles: DataFrame, now: Column) -> DataFrame:
    """A row per region, kind and listed provider (columns title_id, content_kind, d); ``seq`` is the listing order."""
    regions = titles.select(
        "title_id", "content_kind", F.explode(F.col("d")["watch/providers"]["results"]).alias("region", "r")
    )
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"r.{k}").alias("offers")) for k in PROVIDER_KINDS])
    offers = regions.select(
        "title_id", "content_kind", "region", F.col("r.link").alias("link"), F.inline(kinds)
    ).select("title_id", "content_kind", "region", "link", "kind", F.posexplode("offers").alias("seq", "o"))
    return offers.filter(F.col("o.provider_id") != 0).select(
        "title_id", "content_kind", "region", "kind", "o.provider_id", "o.provider_name",
        "o.logo_path", "o.display_priority", "link", now.alias("collected_at"), "seq",
    )


def _ordered_cast(cast: Column) -> Column:
    named = F.filter(cast, lambda c: F.coalesce(c["id"] != 0, F.lit(False)))
    keyed = F.transform(
        named,
        lambda c, i: F.struct(
            F.coalesce(c["order"], F.lit(99999)).alias("o"), i.alias("i"), c.alias("c")
        ),
    )
    return F.transform(F.slice(F.array_sort(keyed), 1, TOP_CAST), lambda k: k["c"])


def _people(crew: Column) -> Column:
    """One entry per person in key jobs: sorted distinct jobs, the rest from the first listing."""
    keep = F.filter(
        crew,
        lambda c: F.coalesce((c["id"] != 0) & c["job"].isin(*KEY_CREW_JOBS), F.lit(False)),
    )

    def person(pid: Column) -> Column:
        own = F.filter(keep, lambda c: c["id"] == pid)
        jobs = F.array_sort(F.array_distinct(F.transform(own, lambda c: c["job"])))
        first = own[0]
        return F.struct(
            pid.alias("id"),
            first["name"].alias("name"),
            F.array_join(jobs, ", ").alias("job"),
            first["department"].alias("department"),
            first["profile_path"].alias("profile_path"),
        )

    return F.transform(F.array_distinct(F.transform(keep, lambda c: c["id"])), person)


def credit_rows(titles: DataFrame, now: Column) -> DataFrame:
    """Top cast and key crew (columns title_id, content_kind, d); ``seq`` is the listing order."""
    cast = titles.select(
        "title_id", "content_kind", F.posexplode(_ordered_cast(F.col("d.credits.cast"))).alias("p", "c")
    ).select(
        "title_id", "content_kind", F.lit("cast").alias("credit_kind"), F.col("c.id").alias("person_id"),
        "c.name", "c.character", F.lit(None).cast("string").alias("job"),
        F.lit("Acting").alias("department"), "c.profile_path",
        F.col("c.order").alias("order_index"), now.alias("collected_at"), F.col("p").alias("seq"),
    )
    crew = titles.select(
        "title_id", "content_kind", F.posexplode(_people(F.col("d.credits.crew"))).alias("p", "c")
    ).select(
        "title_id", "content_kind", F.lit("crew").alias("credit_kind"), F.col("c.id").alias("person_id"),
        "c.name", F.lit(None).cast("string").alias("character"), "c.job", "c.department",
        "c.profile_path", F.lit(0).cast("bigint").alias("order_index"), now.alias("collected_at"),
        F.col("p").alias("seq"),
    )
    return cast.unionByName(crew)


def _title_columns() -> list[Column]:
    return [
        F.col("d.original_language"), F.col("d.status"), F.col("d.popularity"),
        F.col("d.poster_path"), F.col("d.backdrop_path"), F.col("d.overview"),
        F.col("d.tagline"), F.col("d.homepage"),
        fn.genres(F.col("d.genres")).alias("genres"),
        fn.companies(F.col("d.production_companies")).alias("production_companies"),
        fn.origin_countries(F.col("d.origin_country"), F.col("d.production_countries")).alias("origin_countries"),
        fn.languages(F.col("d.spoken_languages")).alias("spoken_languages"),
    ]


def movie_rows(parsed: DataFrame, now: Column) -> DataFrame:
    """Movie rows (columns movie_id, listed_release_date, d); the details' date wins when given."""
    released = F.coalesce(fn.blank_to_null(F.col("d.release_date")), F.col("listed_release_date"))
    return parsed.select(
        "movie_id", "d.imdb_id", "d.title", "d.original_title",
        fn.iso_date(released).alias("release_date"), F.col("d.runtime").alias("runtime_minutes"),
        *_title_columns(), now.alias("collected_at"),
    )


def show_rows(parsed: DataFrame, now: Column) -> DataFrame:
    aired = F.coalesce(fn.blank_to_null(F.col("d.first_air_date")), F.col("listed_first_air_date"))
    return parsed.select(
        "tv_id", "d.name", "d.original_name", fn.iso_date(aired).alias("first_air_date"),
        "d.vote_average", "d.vote_count", fn.companies(F.col("d.networks")).alias("networks"),
        *_title_columns(), now.alias("collected_at"),
    )


def upcoming_seasons(seasons: Column, today: date | str) -> Column:
    """Numbered seasons without an air date, or airing today or later; unparsable dates go.

    Of a season listed more than once the last listing counts.
    """
    last = F.filter(
        seasons,
        lambda s, i: ~F.exists(
            F.slice(seasons, i + 2, F.size(seasons)), lambda z: z["season_number"].eqNullSafe(s["season_number"])
        ),
    )

    def keep(s: Column) -> Column:
        undated = F.coalesce(s["air_date"], F.lit("")) == ""
        ahead = F.coalesce(fn.iso_date(s["air_date"]) >= fn.day(today), F.lit(False))
        return (F.coalesce(s["season_number"], F.lit(0)) != 0) & (undated | ahead)

    return F.filter(last, keep)


def anchor_season(upcoming: Column) -> Column:
    """The season that airs first; undated ones come last, ties keep the listing order."""
    keyed = F.transform(
        upcoming,
        lambda s, i: F.struct(
            F.coalesce(fn.blank_to_null(s["air_date"]), F.lit("9999-12-31")).alias("k"),
            i.alias("i"), s["season_number"].alias("season_number"), s["air_date"].alias("air_date"),
        ),
    )
    return F.array_min(keyed)


def season_rows(shows: DataFrame, now: Column) -> DataFrame:
    """Season rows (columns tv_id, upcoming)."""
    return shows.select("tv_id", F.explode("upcoming").alias("s")).select(
        "tv_id", "s.season_number", "s.name", fn.iso_date(F.col("s.air_date")).alias("air_date"),
        "s.episode_count", "s.overview", "s.poster_path", now.alias("collected_at"),
    )


def item_rows(videos: DataFrame, content_kind: str, now: Column) -> DataFrame:
    """Item rows from single videos ``v``; the frame carries the link columns and an end date."""
    keep = videos.filter(fn.is_tracked_video(F.col("v.site"), F.col("v.type")))
    null_ts = F.lit(None).cast("timestamp")

    def link(c: str) -> Column:
        return (F.col(c) if c in videos.columns else F.lit(None)).cast("bigint").alias(c)

    return keep.select(
        F.col("v.key").alias("item_id"), F.lit(content_kind).alias("content_kind"),
        link("movie_id"), link("tv_id"), link("season_number"),
        fn.video_class(F.col("v.name"), F.col("v.type")).alias("video_type"), "v.name",
        fn.iso_timestamp(F.col("v.published_at")).alias("published_at"),
        F.lit(None).cast("string").alias("channel_id"), F.lit(None).cast("string").alias("channel_title"),
        "v.official", "tracking_end_date", F.lit(None).cast("string").alias("thumbnail_url"),
        now.alias("first_seen_at"), now.alias("last_collected_at"),
        F.lit("active").alias("tracking_status"), F.lit(False).alias("comments_disabled"),
        null_ts.alias("comments_at_discovery_captured_at"),
        null_ts.alias("comments_pre_release_captured_at"), null_ts.alias("transcript_captured_at"),
        "seq",
    )
