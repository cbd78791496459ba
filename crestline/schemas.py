"""Fixed table contracts: columns, merge keys, partition and cluster columns."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

COMPANY = "struct<id:bigint,name:string,logo_path:string,origin_country:string>"
GENRE = "struct<id:bigint,name:string>"
LANGUAGE = "struct<iso_639_1:string,english_name:string,name:string>"

# Enumerated domains of the data model.
CONTENT_KINDS = ("movie", "tv")
VIDEO_TYPES = ("Teaser", "Trailer", "Official Trailer")
TRACKING_STATES = ("active", "ended", "unavailable")
SNAPSHOT_KINDS = ("at_discovery", "pre_release")
PROVIDER_KINDS = ("flatrate", "rent", "buy", "free", "ads")
CREDIT_KINDS = ("cast", "crew")
TRANSCRIPT_SOURCES = ("yta", "whisper", "failed")
PREDICTION_STATES = ("open", "hit", "miss")
REJECT_REASONS = ("unreadable", "other_id")
RUN_PHASES = (
    "discover_movies", "discover_tv", "stats", "comments", "transcripts", "box_office",
    "predictions", "excitement",
)


@dataclass(frozen=True)
class Table:
    ddl: str
    keys: tuple[str, ...]
    partition: str | None = None
    cluster: str | None = None
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return StructType.fromDDL(self.ddl).names

    def update_columns(self) -> list[str]:
        return [c for c in self.columns if c not in self.keys]


TABLES: dict[str, Table] = {
    "movies": Table(
        "movie_id bigint, imdb_id string, title string, original_title string,"
        " original_language string, release_date date,"
        f" genres array<{GENRE}>, status string, popularity double, poster_path string,"
        " backdrop_path string, overview string, tagline string, homepage string,"
        f" runtime_minutes bigint, production_companies array<{COMPANY}>,"
        f" origin_countries array<string>, spoken_languages array<{LANGUAGE}>,"
        " collected_at timestamp",
        ("movie_id",),
    ),
    "shows": Table(
        "tv_id bigint, name string, original_name string, original_language string,"
        f" first_air_date date, status string, genres array<{GENRE}>, vote_average double,"
        " vote_count bigint, popularity double, poster_path string, backdrop_path string,"
        " overview string, tagline string, homepage string,"
        f" production_companies array<{COMPANY}>, networks array<{COMPANY}>,"
        f" origin_countries array<string>, spoken_languages array<{LANGUAGE}>,"
        " collected_at timestamp",
        ("tv_id",),
    ),
    "seasons": Table(
        "tv_id bigint, season_number bigint, name string, air_date date, episode_count bigint,"
        " overview string, poster_path string, collected_at timestamp",
        ("tv_id", "season_number"),
    ),
    "items": Table(
        "item_id string, content_kind string, movie_id bigint, tv_id bigint,"
        " season_number bigint, video_type string, name string, published_at timestamp,"
        " channel_id string, channel_title string, official boolean, tracking_end_date date,"
        " thumbnail_url string, description string, duration_seconds bigint,"
        " definition string, embeddable boolean, region_blocked array<string>,"
        " first_seen_at timestamp, last_collected_at timestamp, tracking_status string,"
        " comments_disabled boolean, comments_at_discovery_captured_at timestamp,"
        " comments_pre_release_captured_at timestamp, transcript_captured_at timestamp",
        ("item_id",),
        domains={
            "content_kind": CONTENT_KINDS,
            "video_type": VIDEO_TYPES,
            "tracking_status": TRACKING_STATES,
        },
    ),
    "counter_snapshots": Table(
        "item_id string, collected_date date, view_count bigint, like_count bigint,"
        " comment_count bigint, favorite_count bigint, collected_at timestamp",
        ("item_id", "collected_date"),
        partition="collected_date",
        cluster="item_id",
    ),
    "comments": Table(
        "item_id string, snapshot_kind string, snapshot_date date, comment_id string,"
        " text string, like_count bigint, total_reply_count bigint, author_channel_id string,"
        " author_display_name string, published_at timestamp, updated_at timestamp,"
        " rank bigint, collected_at timestamp",
        ("item_id", "snapshot_kind", "comment_id"),
        partition="snapshot_date",
        cluster="item_id",
        domains={"snapshot_kind": SNAPSHOT_KINDS},
    ),
    "box_office": Table(
        "movie_id bigint, budget bigint, revenue bigint, runtime_minutes bigint,"
        " release_date_used date, popularity_at_capture double, captured_at timestamp",
        ("movie_id",),
    ),
    "transcripts": Table(
        "item_id string, source string, track_kind string, language string, text string,"
        " word_count bigint, char_count bigint, error string, captured_at timestamp",
        ("item_id",),
        domains={"source": TRANSCRIPT_SOURCES},
    ),
    "providers": Table(
        "title_id bigint, content_kind string, region string, kind string,"
        " provider_id bigint, provider_name string, logo_path string,"
        " display_priority bigint, link string, collected_at timestamp",
        ("title_id", "content_kind", "region", "kind", "provider_id"),
        domains={"content_kind": CONTENT_KINDS, "kind": PROVIDER_KINDS},
    ),
    "credits": Table(
        "title_id bigint, content_kind string, credit_kind string, person_id bigint,"
        " name string, character string, job string, department string, profile_path string,"
        " order_index bigint, collected_at timestamp",
        ("title_id", "content_kind", "credit_kind", "person_id"),
        domains={"content_kind": CONTENT_KINDS, "credit_kind": CREDIT_KINDS},
    ),
    "run_log": Table(
        "run_id string, phase string, started_at timestamp, finished_at timestamp,"
        " items_processed bigint, quota_units_used bigint, errors bigint, notes string",
        ("run_id", "phase"),
        domains={"phase": RUN_PHASES},
    ),
    "heads": Table(
        "version string, trained_at timestamp, coef array<double>, intercept double, mean array<double>,"
        " scale array<double>, layout string, n bigint, mae double, rmse double, baseline_mae double, spearman double,"
        " checks array<struct<check:string,value:double,passed:boolean>>, passed boolean",
        ("version",),
    ),
    "rejects": Table(
        "phase string, item_id string, reason string, content_key string, payload string,"
        " rejected_date date, rejected_at timestamp",
        ("phase", "item_id", "content_key"),
        partition="rejected_date",
        cluster="item_id",
        domains={"phase": RUN_PHASES, "reason": REJECT_REASONS},
    ),
    "predictions": Table(
        "prediction_id string, kind string, movie_id bigint, title string, predicted_at date,"
        " horizon_days bigint, days_to_release_at_prediction bigint,"
        " vs_peak_at_prediction double, basis string, status string, resolved_at date,"
        " resolved_item_id string, resolved_lag_days bigint, created_at timestamp,"
        " updated_at timestamp",
        ("prediction_id",),
        domains={"status": PREDICTION_STATES},
    ),
    "scores": Table(
        "item_id string, model_version string, scored_date date, excitement double,"
        " snapshot_kind string, n_comments bigint, mean_like_count double,"
        " source_snapshot_date date, created_at timestamp",
        ("item_id", "model_version"),
        partition="scored_date",
        cluster="item_id",
        domains={"snapshot_kind": SNAPSHOT_KINDS},
    ),
}

# Columns a discovery run may overwrite on a known item; the rest belongs to other jobs.
DISCOVERY_UPDATE_COLUMNS = (
    "video_type", "name", "published_at", "official", "tracking_end_date", "last_collected_at",
)
# Columns a discovery run writes for a new item.
DISCOVERY_INSERT_COLUMNS = (
    "item_id", "content_kind", "movie_id", "tv_id", "season_number", "video_type", "name",
    "published_at", "channel_id", "channel_title", "official", "tracking_end_date",
    "thumbnail_url", "first_seen_at", "last_collected_at", "tracking_status",
    "comments_disabled", "comments_at_discovery_captured_at",
    "comments_pre_release_captured_at", "transcript_captured_at",
)


def link_is_valid() -> Column:
    """An item hangs on a movie or on a (show, season), never on both or neither."""
    movie = F.col("movie_id").isNotNull()
    season = F.col("tv_id").isNotNull() & F.col("season_number").isNotNull()
    kind = F.col("content_kind")
    return ((kind == "movie") & movie & F.col("tv_id").isNull()) | (
        (kind == "tv") & season & F.col("movie_id").isNull()
    )


def violations(df: DataFrame, table: str) -> DataFrame:
    """Rows breaking the contract: null key, value outside its domain, bad item link."""
    spec = TABLES[table]
    bad = F.lit(False)
    for key in spec.keys:
        bad = bad | F.col(key).isNull()
    for col, allowed in spec.domains.items():
        bad = bad | (F.col(col).isNotNull() & ~F.col(col).isin(*allowed))
    if table == "items":
        bad = bad | ~F.coalesce(link_is_valid(), F.lit(False))
    return df.filter(bad)
