"""Daily jobs: pick targets, flatten what came back, bring the tables up to date.

API calls happen elsewhere; each job takes the raw documents as a DataFrame and
returns the new state of the tables it maintains.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crestline.functions import scalars as fn
from crestline.functions.scalars import day
from crestline.operators.ordering import latest
from crestline.operators.upsert import (
    keep_old_if_empty, keep_old_if_null, last_wins, missing_ids, patch, upsert,
)
from crestline.schemas import DISCOVERY_INSERT_COLUMNS, DISCOVERY_UPDATE_COLUMNS, TABLES
from crestline.sources import payloads as raw

# Collection stops after the grace days, an item ends after the end days.
GRACE_DAYS = 7
END_DAYS = 30


def _capped(df: DataFrame, limit: int | None) -> DataFrame:
    return df if limit is None else df.limit(limit)


# --- target selection -----------------------------------------------------------


def active_targets(
    items: DataFrame, today: date | str, grace: int = GRACE_DAYS, limit: int | None = None
) -> DataFrame:
    """Items to collect today, the soonest-ending first, open-ended ones last.

    ``limit`` is the collector's daily capacity; None takes everything.
    """
    now = day(today)
    published = F.col("published_at").isNull() | (F.to_date("published_at") <= now)
    running = F.col("tracking_end_date").isNull() | (now <= F.date_add("tracking_end_date", grace))
    rows = items.filter((F.col("tracking_status") == "active") & published & running).select(
        "item_id", "tracking_end_date"
    )
    if limit is None:
        return rows
    return rows.orderBy(F.asc_nulls_last("tracking_end_date"), "item_id").limit(limit)


def comment_targets(
    items: DataFrame, kind: str, today: date | str, limit: int | None = None
) -> DataFrame:
    """Items whose comments are due: never captured, or about to be released."""
    open_for = (F.col("tracking_status") == "active") & ~F.col("comments_disabled")
    if kind == "at_discovery":
        due = F.col("comments_at_discovery_captured_at").isNull()
    elif kind == "pre_release":
        due = F.col("comments_pre_release_captured_at").isNull() & F.col("tracking_end_date").between(
            day(today), F.date_add(day(today), 1)
        )
    else:
        raise ValueError("kind must be 'at_discovery' or 'pre_release'")
    return _capped(items.filter(open_for & due).select("item_id"), limit)


def transcript_targets(items: DataFrame, limit: int | None = None) -> DataFrame:
    """Active items without a transcript, the most recently seen first, one row per id."""
    rows = (
        items.filter(F.col("transcript_captured_at").isNull() & (F.col("tracking_status") == "active"))
        .groupBy("item_id")
        .agg(F.max("first_seen_at").alias("first_seen_at"))
    )
    if limit is None:
        return rows
    return rows.orderBy(F.desc("first_seen_at"), "item_id").limit(limit)


def mark_ended(items: DataFrame, today: date | str) -> DataFrame:
    over = (F.col("tracking_status") == "active") & (
        day(today) > F.date_add("tracking_end_date", END_DAYS)
    )
    return items.withColumn(
        "tracking_status", F.when(F.coalesce(over, F.lit(False)), "ended").otherwise(F.col("tracking_status"))
    )


def mark_unavailable(items: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    return patch(
        items, ids.select("item_id", now.alias("now")), ["item_id"],
        {"tracking_status": lambda s, t: F.lit("unavailable"), "last_collected_at": lambda s, t: s("now")},
    )


def patch_registry(items: DataFrame, updates: DataFrame) -> DataFrame:
    """Attributes seen on the latest document; missing ones never erase known ones."""
    return patch(
        items, updates, ["item_id"],
        {
            **keep_old_if_null(
                "channel_id", "channel_title", "thumbnail_url", "description", "duration_seconds",
                "definition", "embeddable",
            ),
            "region_blocked": keep_old_if_empty("region_blocked"),
            "last_collected_at": lambda s, t: s("last_collected_at"),
        },
    )


# --- counters -------------------------------------------------------------------


Hold = Callable[[str, DataFrame], DataFrame]


def _passing(_name: str, df: DataFrame) -> DataFrame:
    return df


@dataclass
class CounterRun:
    counters: DataFrame  # today's counter rows
    snapshots: DataFrame  # snapshot table after the merge
    items: DataFrame  # item registry after all updates
    unavailable: DataFrame  # requested ids that did not come back
    rejects: DataFrame  # rows for the rejects table


def counter_run(
    items: DataFrame,
    snapshots: DataFrame,
    documents: DataFrame,
    today: date | str,
    now: Column,
    hold: Hold = _passing,
) -> CounterRun:
    """Today's counters from raw documents (columns item_id, payload).

    Every document of an active item is used; of several for one item the one
    with the greatest payload. Documents that cannot be read, or that name another id than
    the one asked for, become rejects: their items are neither counted nor taken for
    unavailable. Today's rows are merged into the snapshots of the same day; other days are
    untouched. ``hold`` may store what several outputs read: ``documents`` (parsed once) and ``unavailable``.
    """
    targets = active_targets(items, today).select("item_id")
    returned = documents.join(targets, "item_id", "left_semi").select("item_id", "payload")
    rows = hold("documents", raw.video_rows(returned, today, now))
    good = rows.filter(F.col("reason").isNull())
    spec = TABLES["counter_snapshots"]
    counters = good.select(*spec.columns)
    merged = upsert(snapshots, counters, spec.keys, within=F.col(spec.partition) == day(today))
    gone = hold("unavailable", missing_ids(targets, rows, "item_id"))
    patched = patch_registry(items, good.select("item_id", *raw.REGISTRY))
    rejects = raw.reject_rows(rows.filter(F.col("reason").isNotNull()), "stats", today, now)
    return CounterRun(
        counters, merged, mark_ended(mark_unavailable(patched, gone, now), today), gone, rejects
    )


# --- comments -------------------------------------------------------------------


@dataclass
class CommentRun:
    captured: DataFrame  # today's comment rows
    comments: DataFrame
    items: DataFrame
    outcomes: DataFrame  # item_id, snapshot_kind, state of what was due and came back


def comment_run(
    items: DataFrame, comments: DataFrame, threads: DataFrame, today: date | str, now: Column
) -> CommentRun:
    """Both comment captures of the day.

    ``threads``: item_id, snapshot_kind, state ('ok', 'disabled', 'failed'), payload.
    Failed fetches leave no trace and are tried again another day.
    """
    due = (
        comment_targets(items, "at_discovery", today)
        .withColumn("snapshot_kind", F.lit("at_discovery"))
        .unionByName(
            comment_targets(items, "pre_release", today).withColumn("snapshot_kind", F.lit("pre_release"))
        )
    )
    returned = threads.join(due, ["item_id", "snapshot_kind"], "left_semi")
    ok = returned.filter(F.col("state") == "ok")
    captured = raw.comment_rows(ok, today, now)
    spec = TABLES["comments"]
    staged = captured.withColumn("_seq", F.col("rank"))
    merged = upsert(comments, staged, spec.keys, seq="_seq", within=F.col(spec.partition) == day(today))
    stamps = returned.groupBy("item_id").agg(
        F.max(F.when((F.col("state") == "ok") & (F.col("snapshot_kind") == "at_discovery"), now)).alias("disc"),
        F.max(F.when((F.col("state") == "ok") & (F.col("snapshot_kind") == "pre_release"), now)).alias("pre"),
        F.max(F.when(F.col("state") == "disabled", now)).alias("off"),
    )
    stamped = patch(
        items, stamps, ["item_id"],
        {
            "comments_at_discovery_captured_at": lambda s, t: F.coalesce(
                s("disc"), t("comments_at_discovery_captured_at")
            ),
            "comments_pre_release_captured_at": lambda s, t: F.coalesce(
                s("pre"), t("comments_pre_release_captured_at")
            ),
            "comments_disabled": lambda s, t: t("comments_disabled") | s("off").isNotNull(),
            "last_collected_at": lambda s, t: F.coalesce(s("off"), t("last_collected_at")),
        },
    )
    return CommentRun(captured, merged, stamped, returned.select("item_id", "snapshot_kind", "state"))


# --- discovery ------------------------------------------------------------------


@dataclass
class Discovery:
    """Rows found by one discovery run, one per merge key."""

    titles: DataFrame
    items: DataFrame
    providers: DataFrame
    credits: DataFrame
    seasons: DataFrame | None = None


def merge_discovered_items(items: DataFrame, found: DataFrame) -> DataFrame:
    """New items come in whole; known ones change only in the discovery columns."""
    return upsert(items, found, ["item_id"], DISCOVERY_UPDATE_COLUMNS, DISCOVERY_INSERT_COLUMNS)


def first_listings(listings: DataFrame, key: str) -> DataFrame:
    """One listing per title: regions are walked in order, the first sighting stays.

    A first sighting is one with none before it. Put so, no task that reads listings sorts their documents to cut
    them early, which rarely drops any; each is sorted with its title's other sightings only.
    """
    before = F.lag(F.lit(True)).over(Window.partitionBy(key).orderBy("region_order", "position"))
    return listings.withColumn("_before", before).filter(F.col("_before").isNull()).drop("_before")


def first_documents(listings: DataFrame, key: str) -> DataFrame:
    """The same for a job that stores the documents: sightings are chosen on their narrow columns alone.

    Documents are then spread by title against the hashed choice and never sorted.
    A listing that stands twice at one place comes out twice.
    """
    place = ["region_order", "position"]
    first = listings.groupBy(key).agg(F.min(F.struct(*place)).alias("_at")).select(key, "_at.*")
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"f.{c}")) for c in (key, *place)]
    return listings.alias("l").join(first.hint("shuffle_hash").alias("f"), same, "left_semi")


def _parsed(listings: DataFrame, key: str, columns: dict[str, tuple[str, str]], hold: Hold | None) -> DataFrame:
    """First listings with their documents parsed, each into its own column; stored once if ``hold`` is given."""
    first = first_documents(listings, key) if hold else first_listings(listings, key)
    parsed = first.filter(F.col("details").isNotNull())
    for name, (column, schema) in columns.items():
        parsed = raw.parse(parsed, column, schema, name)
    parsed = parsed.drop(*[column for column, _ in columns.values()])
    return hold("documents", parsed) if hold else parsed


def _title_docs(parsed: DataFrame, key: str, kind: str) -> DataFrame:
    return parsed.select(F.col(key).alias("title_id"), F.lit(kind).alias("content_kind"), "d")


def _one_per_key(rows: DataFrame, table: str) -> DataFrame:
    return last_wins(rows, TABLES[table].keys, "seq")


def _one_row(rows: DataFrame, keys: list[str], hold: Hold | None) -> DataFrame:
    """Stored documents may repeat a title."""
    return last_wins(rows, keys, None) if hold else rows


def discover_movies(listings: DataFrame, now: Column, hold: Hold | None = None) -> Discovery:
    """Movies, items, providers and credits from discovery listings.

    ``listings``: region_order, position, movie_id, listed_release_date, details
    (JSON, null when the fetch failed), videos (JSON array, null when failed). With ``hold`` the
    parsed ``documents`` are stored: they are read and parsed once, and every output reads its columns of
    them; without it a single output is planned on its own.
    """
    columns = {"d": ("details", raw.MOVIE_DETAILS), "vs": ("videos", raw.VIDEOS)}
    parsed = _parsed(listings, "movie_id", columns, hold)
    movies = _one_row(raw.movie_rows(parsed, now), ["movie_id"], hold)
    released = F.coalesce(fn.blank_to_null(F.col("d.release_date")), F.col("listed_release_date"))
    videos = parsed.select(
        "movie_id", fn.iso_date(released).alias("tracking_end_date"),
        "region_order", "position", F.posexplode("vs").alias("vpos", "v"),
    ).withColumn("seq", F.struct("region_order", "position", "vpos"))
    found = _one_per_key(raw.item_rows(videos, "movie", now), "items")
    docs = _title_docs(parsed, "movie_id", "movie")
    credit_rows = _one_per_key(raw.credit_rows(docs, now), "credits")
    return Discovery(movies, found, _one_per_key(raw.provider_rows(docs, now), "providers"), credit_rows)


def discover_tv(listings: DataFrame, today: date | str, now: Column, hold: Hold | None = None) -> Discovery:
    """Shows, upcoming seasons and their items.

    ``listings``: region_order, position, tv_id, listed_first_air_date, details,
    season_videos (JSON array of season_number and videos), series_videos.
    Series-level videos go to the season that airs first. ``hold`` as in ``discover_movies``.
    """
    columns = {
        "d": ("details", raw.SHOW_DETAILS), "sv": ("season_videos", raw.SEASON_VIDEOS),
        "vs": ("series_videos", raw.VIDEOS),
    }
    parsed = _parsed(listings, "tv_id", columns, hold)
    shows = _one_row(raw.show_rows(parsed, now), ["tv_id"], hold)
    ahead = (
        parsed.withColumn("upcoming", raw.upcoming_seasons(F.col("d.seasons"), today))
        .filter(F.size("upcoming") > 0)
        .withColumn("anchor", raw.anchor_season(F.col("upcoming")))
    )
    seasons = _one_row(raw.season_rows(ahead, now), ["tv_id", "season_number"], hold)
    order = ["region_order", "position"]
    dates = F.map_from_entries(
        F.transform("upcoming", lambda s: F.struct(s["season_number"], s["air_date"]))
    )
    per_season = (
        ahead.withColumn("dates", dates)
        .select("tv_id", *order, "dates", F.posexplode("sv").alias("spos", "s"))
        .filter(F.map_contains_key("dates", F.col("s.season_number")))
        .select(
            "tv_id", *order, F.col("s.season_number").alias("season_number"), "spos",
            fn.iso_date(F.col("dates")[F.col("s.season_number")]).alias("tracking_end_date"),
            F.posexplode("s.videos").alias("vpos", "v"),
        )
        .withColumn("seq", F.struct(*order, F.lit(0).alias("level"), "spos", "vpos"))
    )
    per_series = (
        ahead.select(
            "tv_id", *order, F.col("anchor.season_number").alias("season_number"),
            fn.iso_date(F.col("anchor.air_date")).alias("tracking_end_date"),
            F.posexplode("vs").alias("vpos", "v"),
        )
        .withColumn("seq", F.struct(*order, F.lit(1).alias("level"), F.lit(0).alias("spos"), "vpos"))
    )
    both = raw.item_rows(per_season, "tv", now).unionByName(raw.item_rows(per_series, "tv", now))
    docs = _title_docs(parsed, "tv_id", "tv")
    return Discovery(
        shows, _one_per_key(both, "items"), _one_per_key(raw.provider_rows(docs, now), "providers"),
        _one_per_key(raw.credit_rows(docs, now), "credits"), seasons,
    )


# --- transcripts ----------------------------------------------------------------


def transcript_rows(attempts: DataFrame, now: Column) -> DataFrame:
    """Transcript rows from capture attempts.

    ``attempts``: item_id, caption_text, caption_kind, caption_error,
    speech_text, speech_language, speech_kind, speech_error. Captions win; an
    item with neither text is kept as failed with both error tags.
    """
    caption = fn.blank_to_null(F.col("caption_text"))
    speech = fn.blank_to_null(F.col("speech_text"))
    text = F.coalesce(caption, speech)
    by_caption, by_speech = caption.isNotNull(), caption.isNull() & speech.isNotNull()
    error = F.concat(
        F.lit("yta="), fn.short_error(F.col("caption_error")),
        F.lit("; whisper="), fn.short_error(F.col("speech_error")),
    )
    return attempts.select(
        "item_id",
        F.when(by_caption, "yta").when(by_speech, "whisper").otherwise("failed").alias("source"),
        F.when(by_caption, F.col("caption_kind")).when(by_speech, F.col("speech_kind")).alias("track_kind"),
        F.when(by_caption, "en").when(by_speech, F.col("speech_language")).alias("language"),
        text.alias("text"),
        fn.word_count(text).alias("word_count"),
        fn.char_count(text).alias("char_count"),
        F.when(text.isNull(), error).alias("error"),
        now.alias("captured_at"),
    )


def transcript_run(
    items: DataFrame, transcripts: DataFrame, attempts: DataFrame, now: Column,
    limit: int | None = None, hold: Hold = _passing,
) -> tuple[DataFrame, DataFrame]:
    """(transcripts, items) after the run; success and failure both set the guard."""
    targets = transcript_targets(items, limit).select("item_id")
    rows = hold("transcripts", transcript_rows(attempts.join(targets, "item_id", "left_semi"), now))
    merged = upsert(transcripts, rows, TABLES["transcripts"].keys)
    stamped = patch(
        items, rows.select("item_id", "captured_at"), ["item_id"],
        {"transcript_captured_at": lambda s, t: s("captured_at")},
    )
    return merged, stamped
