"""Every operator as a named query over the star-schema files."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crestline.functions import scalars as fn
from crestline.functions.lexicon import hype_points
from crestline.operators.ordering import latest
from crestline.operators.upsert import missing_ids, patch, upsert
from crestline.plans import (
    findings, ingest, metrics, predictions, reads, reports, scores, scoring, series, training, trends,
)
from crestline.schemas import TABLES, violations
from crestline.session import pin, scratch_path
from crestline.sources import payloads as raw
from crestline.sources import seeds, sinks, tables
from crestline.sources.testbed import AS_OF, NOW, Testbed
from crestline.streaming import counters as stream
from crestline.workspace import Workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def flat(df: DataFrame) -> DataFrame:
    """Arrays of text joined by ``|``, instants as text: values that compare the same anywhere."""
    out = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StringType):
            c = F.array_join(c, "|")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DoubleType):
            c = F.round(c, 6)
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("bigint")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(fn_: Callable[[Testbed], DataFrame]) -> Callable[[Testbed], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")  # days are UTC days
        return flat(fn_(Testbed(spark, sf_dir)))

    QUERIES[fn_.__name__] = run
    return fn_


def now():
    return F.lit(NOW).cast("timestamp")


def shaped(df: DataFrame, table: str) -> DataFrame:
    """The columns of a table's contract; those the frame lacks are null."""
    schema = T.StructType.fromDDL(TABLES[table].ddl)
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])


def titled(t: Testbed) -> DataFrame:
    return reads.titled_items(t.items, t.movies, t.shows, t.seasons)


def sequence(t: Testbed, version: str | None = None) -> DataFrame:
    return metrics.current_sequence(t.scores, t.items, AS_OF, version)


# --- reads ----------------------------------------------------------------------


@query
def trending(t):
    return reads.trending(t.snapshots, t.items, t.movies, t.shows, t.seasons, AS_OF)


@query
def trending_maintained(t):
    """The same over a maintained counter table that was merged out of order, read through its seeds."""
    path = scratch_path(t.spark, "counters")
    counters = tables.day_table(t.spark, path, "counter_snapshots")
    keys = TABLES["counter_snapshots"].keys
    snapshots = pin(t.snapshots)
    for part in ("day(collected_date) between 6 and 25", "day(collected_date) > 25", "day(collected_date) < 6"):
        seeds.merge_counters(counters, snapshots.filter(part), keys)
    start = date.fromisoformat(AS_OF) - timedelta(days=reads.TRENDING_DAYS)
    return reads.trending(seeds.recent(counters, start), t.items, t.movies, t.shows, t.seasons, AS_OF)


@query
def trending_country(t):
    return reads.trending(
        t.snapshots, t.items, t.movies, t.shows, t.seasons, AS_OF, 14, content_kind="movie", country="US"
    )


@query
def daily_metrics(t):
    return metrics.daily_metrics(t.snapshots, t.items, AS_OF)


@query
def daily_metrics_recent(t):
    return metrics.daily_metrics(t.snapshots, t.items, AS_OF, since=7)


@query
def item_metrics_one(t):
    """The history of whichever item is growing most."""
    top = reads.growth(t.snapshots, AS_OF, 7).orderBy(F.desc("views_gained"), "item_id").limit(1)
    return reads.item_metrics(t.snapshots, t.items, AS_OF, top.select("item_id").scalar())


@query
def search_items(t):
    rows = reads.find_items(
        t.items, t.movies, t.shows, t.seasons, content_kind="movie", country="US", query_text="i_g"
    )
    return rows.drop("thumbnail_url")


@query
def title_resolution(t):
    return titled(t).drop("thumbnail_url")


@query
def top_comments_latest(t):
    return reads.top_comments(t.comments, AS_OF).select(
        "item_id", "snapshot_kind", "snapshot_date", "rank", "comment_id", "text", "like_count", "position"
    )


@query
def top_comments_kind(t):
    return reads.top_comments(t.comments, AS_OF, snapshot_kind="at_discovery", limit=3).select(
        "item_id", "snapshot_date", "rank", "comment_id", "like_count", "position"
    )


@query
def country_stats(t):
    return reads.country_stats(t.items, t.movies, t.shows)


@query
def coverage(t):
    return reads.coverage(reads.country_stats(t.items, t.movies, t.shows), t.items)


@query
def top_countries(t):
    return reads.top_countries(reads.country_stats(t.items, t.movies, t.shows))


@query
def carousel(t):
    return reads.carousel(t.snapshots, t.items, t.movies, t.shows, t.seasons, AS_OF)


@query
def representative_item(t):
    return reads.representative_item(t.comments, t.items, AS_OF)


@query
def latest_stats_candidates(t):
    return reads.regional_candidates(t.items, t.movies, t.snapshots, AS_OF)


# --- trends ---------------------------------------------------------------------


@query
def movie_series(t):
    return trends.movie_series(t.snapshots, t.items, AS_OF, 30)


@query
def engagement_trend(t):
    return trends.engagement_trend(t.snapshots, t.items, AS_OF)


@query
def recent_launches(t):
    return trends.recent_launches(t.items, AS_OF, 20)


@query
def engagement_decay_group(t):
    return trends.engagement_decay(t.snapshots, t.items, AS_OF)


@query
def engagement_decay_item(t):
    return trends.engagement_decay(t.snapshots, t.items, AS_OF, unit="item")


@query
def view_candidates(t):
    return series.view_candidates(t.snapshots, t.items, t.movies, AS_OF, min_peak=20)


@query
def view_timeseries(t):
    return series.view_timeseries(t.snapshots, t.items, t.movies, AS_OF, min_peak=20)


# --- scores ---------------------------------------------------------------------


@query
def score_sequence(t):
    return metrics.score_sequence(t.scores, t.items, AS_OF)


@query
def latest_score_version(t):
    return metrics.latest_version(t.scores, AS_OF)


@query
def score_decay(t):
    return scores.score_decay(sequence(t))


@query
def score_trend(t):
    return scores.score_trend(sequence(t, "m1"))


@query
def score_examples(t):
    return scores.score_examples(t.scores, t.items, t.movies, AS_OF)


# --- findings and predictions -----------------------------------------------------


def _facts(t):
    return findings.movie_facts(t.snapshots, t.items, AS_OF)


def _scan(t):
    return findings.movie_scan(_facts(t), t.items, t.movies, AS_OF)


def _public(df):
    return df.drop("_priority")


@query
def finding_trailer_due(t):
    return _public(findings.trailer_due(_scan(t)))


@query
def finding_surging(t):
    return _public(findings.surging(_scan(t)))


@query
def finding_quality_slide(t):
    return _public(findings.quality_slide(_scan(t)))


@query
def finding_fatigue(t):
    return _public(findings.excitement_fatigue(sequence(t), _facts(t), t.movies))


def _findings(t, top=6):
    return findings.detect_findings(t.snapshots, t.items, t.movies, AS_OF, sequence(t), top=top)


@query
def findings_top(t):
    return _findings(t)


@query
def findings_all(t):
    return _findings(t, top=None)


@query
def finding_series(t):
    return findings.finding_series(pin(_findings(t)), t.snapshots, t.items, AS_OF, sequence(t))


@query
def predictions_open(t):
    return predictions.open_predictions(t.predictions).select(
        "prediction_id", "movie_id", "predicted_at", "horizon_days"
    )


@query
def predictions_recorded(t):
    # the calls of odd movies come from elsewhere, so that some are new
    log = t.predictions.withColumn("movie_id", F.expr("if(movie_id % 2 = 1, -movie_id, movie_id)"))
    return predictions.new_predictions(log, _findings(t, top=None), AS_OF, now())


@query
def predictions_resolved(t):
    return predictions.resolutions(t.predictions, t.items, AS_OF)


@query
def predictions_daily_update(t):
    log = predictions.daily_update(t.predictions, t.items, _findings(t, top=None), AS_OF, now())
    return log.select(
        "prediction_id", "movie_id", "predicted_at", "status", "resolved_at", "resolved_item_id",
        "resolved_lag_days", "updated_at",
    )


@query
def track_record(t):
    return predictions.track_record(
        predictions.resolve_predictions(t.predictions, t.items, AS_OF, now())
    )


# --- keyed merge ----------------------------------------------------------------


def _order_totals(t):
    """A customer table with order figures, and staged orders with repeated customer keys."""
    target = t.raw("customer").selectExpr(
        "if(c_custkey % 3 = 0, -c_custkey, c_custkey) as k",  # every third one has no orders
        "c_name as name", "c_acctbal as amount", "cast(null as string) as status",
    )
    staged = t.raw("orders").selectExpr(
        "o_custkey as k", "concat('order ', o_orderkey) as name", "o_totalprice as amount",
        "o_orderstatus as status", "o_orderkey as seq",
    )
    return target, staged


@query
def upsert_merge(t):
    target, staged = _order_totals(t)
    return upsert(target, staged, ["k"], ["amount", "status"], ["k", "name", "amount"], seq="seq")


@query
def patch_update(t):
    target, staged = _order_totals(t)
    blank = staged.withColumn("status", F.when(F.col("status") != "P", F.col("status")))
    return patch(
        target, blank, ["k"],
        {"status": lambda s, o: F.coalesce(s("status"), F.lit("kept")), "amount": lambda s, o: s("amount") + o("amount")},
        seq="seq",
    )


@query
def mark_missing(t):
    gone = missing_ids(t.items, t.video_documents, "item_id")
    return ingest.mark_unavailable(t.items, gone, now()).select("item_id", "tracking_status", "last_collected_at")


@query
def mark_ended(t):
    return ingest.mark_ended(t.items, "2024-02-20").select("item_id", "tracking_status")


@query
def table_merge(t):
    """Snapshots stored by day, today's counters merged into the stored table, read back."""
    path = scratch_path(t.spark, "merge")
    tables.save(t.snapshots, path, "counter_snapshots")
    staged = pin(raw.counter_rows(t.video_documents, AS_OF, now()))
    staged = staged.unionByName(staged.withColumn("view_count", F.lit(-1).cast("bigint")))  # older readings of the same day
    spec = TABLES["counter_snapshots"]
    tables.day_table(t.spark, path, "counter_snapshots").merge(staged, spec.keys)
    return tables.scan(t.spark, path, "counter_snapshots", since=tables.floor_for("counter_snapshots", AS_OF)).drop(
        "collected_at"
    )


@query
def bounded_scan(t):
    """The last days of a day-partitioned table."""
    path = scratch_path(t.spark, "scan")
    tables.save(t.snapshots, path, "counter_snapshots")
    since = fn.days_before(AS_OF, 3)
    return tables.scan(t.spark, path, "counter_snapshots", since=since).drop("collected_at", "favorite_count")


@query
def sql_read(t):
    """A parametrised SQL read over named frames."""
    return tables.query(
        t.spark,
        "SELECT tracking_status, count(*) AS n, max(duration_seconds) AS longest FROM {catalog_items}"
        " WHERE duration_seconds >= :shortest AND content_kind = :kind GROUP BY tracking_status",
        {"catalog_items": t.items}, shortest=45, kind="movie",
    )


@query
def contract_check(t):
    """Rows of each derived table that break its contract."""
    frames = {"items": t.items, "counter_snapshots": t.snapshots, "comments": t.comments, "predictions": t.predictions}
    counts = [
        violations(df, name).agg(F.lit(name).alias("table_name"), F.count("*").alias("violations"))
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


# --- target selection -------------------------------------------------------------


@query
def select_active(t):
    return ingest.active_targets(t.items, AS_OF)


@query
def select_active_soonest(t):
    """The twenty that end first; open-ended items come last."""
    return ingest.active_targets(t.items, AS_OF, limit=20)


@query
def select_at_discovery(t):
    return ingest.comment_targets(t.items, "at_discovery", AS_OF)


@query
def select_pre_release(t):
    return ingest.comment_targets(t.items, "pre_release", AS_OF)


@query
def select_untranscribed(t):
    return ingest.transcript_targets(t.items)


@query
def anti_join_unscored(t):
    # every third item's scores are from another version
    scores = t.scores.withColumn("model_version", F.expr("if(substr(item_id, 2) % 3 = 0, 'old', model_version)"))
    return scoring.unscored_items(t.comments, scores, "m1", AS_OF)


# --- documents ------------------------------------------------------------------


@query
def flatten_stats_json(t):
    return raw.counter_rows(t.video_documents, AS_OF, now())


@query
def flatten_registry_json(t):
    return raw.registry_patch(t.video_documents, now())


@query
def flatten_comments_json(t):
    return raw.comment_rows(t.turn_threads, AS_OF, now()).drop("author_channel_id", "updated_at")


def _movies(t):
    return ingest.discover_movies(t.movie_listings, now())


def _tv(t):
    return ingest.discover_tv(t.tv_listings, AS_OF, now())


@query
def flatten_movies_json(t):
    def listed(column: str, *fields: str):
        """Every entry's fields, joined; a missing field is ``-``."""
        one = lambda x: F.concat_ws("/", *[F.coalesce(x[f].cast("string"), F.lit("-")) for f in fields])
        return F.array_join(F.transform(column, one), "|").alias(column)

    return _movies(t).titles.select(
        "movie_id", "title", "release_date", "runtime_minutes", "status", "popularity", "poster_path",
        "origin_countries", listed("genres", "id", "name"),
        listed("production_companies", "id", "name", "logo_path", "origin_country"),
        listed("spoken_languages", "iso_639_1", "english_name", "name"),
    )


@query
def flatten_movie_items_json(t):
    return _movies(t).items.select(
        "item_id", "content_kind", "movie_id", "video_type", "name", "published_at", "official",
        "tracking_end_date", "tracking_status",
    )


@query
def flatten_providers_json(t):
    return _movies(t).providers.drop("logo_path")


@query
def flatten_credits_json(t):
    return _movies(t).credits.drop("profile_path")


@query
def flatten_shows_json(t):
    return _tv(t).titles.select("tv_id", "name", "first_air_date", "origin_countries", "popularity")


@query
def flatten_seasons_json(t):
    return _tv(t).seasons.select("tv_id", "season_number", "name", "air_date", "episode_count")


@query
def flatten_tv_items_json(t):
    return _tv(t).items.select(
        "item_id", "tv_id", "season_number", "video_type", "name", "official", "tracking_end_date"
    )


@query
def discovery_merge(t):
    merged = ingest.merge_discovered_items(
        t.items,
        latest(
            _movies(t).items.withColumn("item_id", F.concat(F.lit("v"), F.col("movie_id").cast("string"))),
            ["item_id"], [F.col("name")],
        ),
    )
    return merged.select("item_id", "content_kind", "movie_id", "tracking_end_date", "tracking_status", "channel_title")


@query
def counter_run_items(t):
    run = ingest.counter_run(t.items, t.snapshots, t.video_documents, AS_OF, now())
    return run.items.select(
        "item_id", "tracking_status", "channel_id", "channel_title", "thumbnail_url", "duration_seconds",
        "region_blocked", "last_collected_at",
    )


@query
def counter_run_snapshots(t):
    run = ingest.counter_run(t.items, t.snapshots, t.video_documents, AS_OF, now())
    return run.snapshots.drop("collected_at")


def _faulty(t):
    """The documents with some cut short, some with text after them, and some about another item."""
    n = F.expr("cast(substring(item_id, 2) as bigint)")
    payload = F.col("payload")
    return t.video_documents.select(
        "item_id",
        F.when(n % 13 == 0, F.concat(payload, F.lit(" {}")))
        .when(n % 17 == 0, F.substring(payload, 1, 40))
        .when(n % 19 == 0, F.regexp_replace(payload, '"id":"v', '"id":"w'))
        .otherwise(payload).alias("payload"),
    )


@query
def flatten_rejects(t):
    """Documents that are not booked, with the reason, as they lie in the rejects table after two equal runs."""
    path = scratch_path(t.spark, "rejects")
    table = tables.day_table(t.spark, path, "rejects")
    for _ in range(2):
        run = ingest.counter_run(t.items, t.snapshots, _faulty(t), AS_OF, now())
        table.merge(pin(run.rejects), TABLES["rejects"].keys)
    return table.read().select("phase", "item_id", "reason", "rejected_date")


@query
def counter_run_faulty(t):
    """Counters of the same run: an item whose document is about another item has none."""
    run = ingest.counter_run(t.items, t.snapshots, _faulty(t), AS_OF, now())
    return run.counters.select("item_id", "view_count", "like_count", "comment_count")


@query
def run_log(t):
    """A day of jobs over a workspace: the log's rows, with the outcome counts of every phase."""
    ws = Workspace(t.spark, scratch_path(t.spark, "day"), date.fromisoformat(AS_OF))
    for name in ("items", "predictions"):
        ws.replace(name, shaped(getattr(t, name), name))
    for name, df in (("comments", t.comments), ("scores", t.scores)):
        ws.days(name).save(shaped(df, name))
    blank = t.embedded_comments.withColumn("text", F.expr("if(substr(item_id, 2) % 5 = 0, ' ', text)"))
    log = ws.run_day(
        datetime.fromisoformat(NOW), documents=_faulty(t), threads=t.item_threads, embedded=blank, head=demo_head(),
        dim=64, attempts=t.transcript_attempts, predict=False, run_id="r1",
    )
    stored = ws.table("run_log").join(log.select("run_id", "phase"), ["run_id", "phase"])
    counts = F.explode(F.from_json("notes", "map<string, bigint>")).alias("outcome", "n")
    return stored.select("phase", "items_processed", "errors", counts)


@query
def comment_run_items(t):
    run = ingest.comment_run(t.items, t.comments, t.item_threads, AS_OF, now())
    return run.items.select(
        "item_id", "comments_disabled", "comments_at_discovery_captured_at",
        "comments_pre_release_captured_at", "last_collected_at",
    )


@query
def comment_run_rows(t):
    run = ingest.comment_run(t.items, t.comments, t.item_threads, AS_OF, now())
    return run.comments.select("item_id", "snapshot_kind", "comment_id", "snapshot_date", "rank", "like_count")


@query
def transcript_run_items(t):
    empty = t.spark.createDataFrame([], TABLES["transcripts"].ddl)
    _, items = ingest.transcript_run(t.items, empty, t.transcript_attempts, now())
    return items.select("item_id", "transcript_captured_at")


@query
def transcript_rows(t):
    return ingest.transcript_rows(t.transcript_attempts, now()).drop("text")


# --- scalars and text -------------------------------------------------------------


@query
def duration_parse(t):
    doc = raw.parse(t.video_documents, "payload", raw.VIDEO_STATS, "v")
    text = F.col("v.contentDetails.duration")
    return doc.select("item_id", text.alias("duration"), fn.duration_seconds(text).alias("seconds"))


@query
def word_counts(t):
    text = F.col("text")
    return t.raw("documents").select(
        "doc_id", fn.word_count(text).alias("words"), fn.char_count(text).alias("chars")
    )


@query
def jaccard_pairs(t):
    return reports.neighbour_similarity(t.raw("documents"), "doc_id")


@query
def lexicon_rate(t):
    points = hype_points(F.col("text"))
    return t.raw("documents").groupBy("source").agg(
        F.count("*").alias("texts"), F.avg(points).alias("rate"), F.max(points).alias("most")
    )


@query
def preview_rows(t):
    rows = t.raw("documents").select("doc_id", fn.words(F.col("text")).alias("words"), "text")
    return sinks.trimmed(rows)


@query
def json_rows(t):
    rows = t.snapshots.select("item_id", "collected_date", "view_count", "like_count", "collected_at")
    return sinks.as_json(rows)


# --- scoring ----------------------------------------------------------------------


@query
def unit_vectors(t):
    unit = fn.unit_vector(F.col("embedding"))
    return t.raw("embeddings").select("vec_id", F.posexplode(unit).alias("dim", "x"))


@query
def comment_sets(t):
    sets = scoring.comment_sets(scoring.discovery_comments(t.comments, AS_OF))
    texts = F.transform("comments", lambda c: c["rank"].cast("string"))
    return sets.select(
        "item_id", "n_comments", "mean_like_count", "source_snapshot_date", texts.alias("ranks")
    )


@query
def training_set(t):
    sets = scoring.comment_sets(scoring.discovery_comments(t.comments, AS_OF))
    rows = sinks.training_set(sets, t.items, t.movies)
    return rows.withColumn("comments", F.transform("comments", lambda c: c["text"]))


@query
def pooled_features(t):
    pooled = scoring.pooled_features(scoring.discovery_comments(t.embedded_comments, AS_OF))
    return pooled.select("item_id", F.posexplode("features").alias("dim", "x"))


def demo_head(dim: int = 64) -> scoring.LinearHead:
    n = dim + scoring.AUX_FEATURES
    return scoring.LinearHead(
        "h1", [((i * 7) % 13 - 6) * 2.0 for i in range(n)], 40.0, [0.01 * (i % 5) for i in range(n)],
        [0.5 + 0.1 * (i % 3) for i in range(n)], scoring.feature_layout(dim),
    )


@query
def linear_scores(t):
    pooled = scoring.pooled_features(scoring.discovery_comments(t.embedded_comments, AS_OF))
    return scoring.linear_scores(pooled, demo_head()).select("item_id", "excitement")


@query
def head_roundtrip(t):
    """The same scores from a head that was saved and loaded again."""
    path = scratch_path(t.spark, "head")
    scoring.save_head(t.spark, demo_head(), path)
    head = scoring.load_head(t.spark, path, scoring.feature_layout(64))
    pooled = scoring.pooled_features(scoring.discovery_comments(t.embedded_comments, AS_OF))
    return scoring.linear_scores(pooled, head).select("item_id", "excitement")


@query
def scoring_job(t):
    scored, _ = scoring.score_run(t.embedded_comments, t.scores, demo_head(), AS_OF, now(), 64)
    return scored


@query
def scoring_job_merged(t):
    head = demo_head()
    # two thirds of the items were scored by this head
    known = t.scores.withColumn(
        "model_version", F.expr(f"if(model_version = 'm2' and substr(item_id, 2) % 3 <> 0, '{head.version}', model_version)")
    )
    _, merged = scoring.score_run(t.embedded_comments, known, head, AS_OF, now(), 64)
    return merged.groupBy("model_version", "scored_date").agg(F.count("*").alias("n"))


def _labels(t):
    """A label per item, from the vector class."""
    return t.raw("embeddings").selectExpr(
        "concat('v', vec_id) as item_id", "cast(label * 10 as double) as excitement"
    )


def _features(t):
    return training.training_table(
        scoring.discovery_comments(t.embedded_comments, AS_OF), _labels(t), metrics.movie_links(t.items)
    )


@query
def feature_table(t):
    return _features(t).select("item_id", "movie_id", "y", F.posexplode("features").alias("dim", "x"))


@query
def ridge_train(t):
    _, oof = training.train(_features(t), "r1", scoring.feature_layout(64))
    return training.fit_quality(oof)


@query
def ridge_small(t):
    """Ridge on two features: small enough for SQL to solve in closed form."""
    rows = t.raw("embeddings").selectExpr(
        "concat('v', vec_id) as item_id", "vec_id % 97 as movie_id", "cast(vec_id % 97 % 5 as int) as fold",
        "array(cast(embedding[0] as double), cast(embedding[1] as double)) as features",
        "50D + 100 * cast(embedding[0] as double) - 60 * cast(embedding[1] as double) + label as y",
    )
    _, oof = training.train(rows, "r2", "two features")
    return training.fit_quality(oof)


@query
def fit_quality(t):
    s = t.scores.filter("excitement is not null")
    both = s.groupBy("item_id").pivot("model_version", ["m1", "m2"]).agg(F.first("excitement"))
    whole = both.select(F.round("m1", 0).alias("y"), F.round("m2", 0).alias("oof"))
    return training.fit_quality(whole)


def _gate_rows(t):
    comments = scoring.discovery_comments(t.comments, AS_OF)
    links = metrics.movie_links(t.items).select("item_id", "movie_id", "published_at")
    scored = t.scores.filter("model_version = 'm1'").select("item_id", "excitement")
    return scored.join(scoring.lexicon_rates(comments), "item_id").join(links, "item_id")


@query
def acceptance_gate(t):
    return training.acceptance_gate(_gate_rows(t))


@query
def acceptance_summary(t):
    """Declines by the model score and by the hype signal alone."""
    seq = pin(training.gate_sequence(_gate_rows(t)))
    both = [
        training.decline_summary(seq, value).withColumn("score", F.lit(value)) for value in ("excitement", "lexicon")
    ]
    return both[0].unionByName(both[1])


def _labels_file(t) -> str:
    """Labels as lines of JSON, some of them broken or without a score."""
    path = scratch_path(t.spark, "labels")
    line = F.when(F.expr("substr(item_id, 2) % 11 = 4"), F.lit("{broken")).when(
        F.expr("substr(item_id, 2) % 13 = 5"), F.to_json(F.struct("item_id"))
    ).otherwise(F.to_json(F.struct("item_id", "excitement")))
    _labels(t).select(line.alias("value")).write.text(path)
    return path


@query
def labels_join(t):
    """Labels read back from their file, beside the items they belong to."""
    labels = tables.read_labels(t.spark, _labels_file(t))
    return labels.join(t.items.select("item_id", "content_kind", "movie_id"), "item_id")


@query
def training_job(t):
    """A head from the labels file through its gate into the registry; the gate's checks and what became current."""
    ws = Workspace(t.spark, scratch_path(t.spark, "heads"), date.fromisoformat(AS_OF))
    ws.replace("items", shaped(t.items, "items"))
    ws.train_head(_labels_file(t), t.embedded_comments, "r1", now(), 64)
    heads = ws.table("heads")
    return heads.select("version", "n", "passed", F.inline("checks").alias("check", "value", "check_passed"))


@query
def site_documents(t):
    """Documents published by a workspace and read back from the current folder, one row per number."""
    ws = Workspace(t.spark, scratch_path(t.spark, "site-tables"), date.fromisoformat(AS_OF))
    for name in ("items", "movies", "shows", "seasons"):
        ws.replace(name, shaped(getattr(t, name), name))
    for name, df in (("counter_snapshots", t.snapshots), ("scores", t.scores), ("comments", t.comments)):
        ws.days(name).save(shaped(df, name))
    out = scratch_path(t.spark, "site")
    ws.write_site(out, datetime.fromisoformat(NOW))

    def document(name):
        return t.spark.read.json(sinks.site_path(t.spark, out, name))

    def numbers(name, *values):
        pairs = F.array(*[F.struct(F.lit(k).alias("entry"), v.cast("double").alias("value")) for k, v in values])
        return document(name).select(F.lit(name).alias("document"), F.inline(pairs))

    many = F.col("by_movie_item_count")
    coverage = [(c, F.col(c)) for c in ("unique_items", "countries_covered", "total_attributions", "active_items")]
    parts = [
        numbers("coverage", *coverage),
        document("coverage").select(F.lit("coverage").alias("document"), F.inline("top_countries").alias("entry", "value")),
        numbers("engagement_decay", ("days", F.col("days")), ("units", F.col("units")), ("losing", F.col("losing")),
                ("4+ units", many["4+"]["units"])),
        numbers("excitement_decay", ("movies", F.col("movies")), ("declining", F.col("declining")),
                ("2 movies", many["2"]["movies"]), ("m2", (F.col("model_version") == "m2").cast("int"))),
        document("excitement_examples").groupBy().agg(F.count("*").alias("value"), F.max("model_version").alias("entry"))
        .select(F.lit("excitement_examples").alias("document"), "entry", F.col("value").cast("double")),
    ]
    return reduce(DataFrame.unionByName, [p.withColumn("value", F.col("value").cast("double")) for p in parts])


# --- reports ----------------------------------------------------------------------


@query
def item_windows(t):
    return reports.item_windows(t.items)


def _matches(t):
    """Window matches out of the line items: order = item, mode = method, part = track."""
    return t.raw("lineitem").selectExpr(
        "cast(l_orderkey as string) as item_id", "l_returnflag as method", "l_discount >= 0.05 as success",
        "case when l_partkey % 17 <> 0 then concat('t', l_partkey % 40) else '' end as title",
        "concat('a', l_suppkey % 10) as artist", "l_tax as score", "l_linenumber * 15 as start_seconds",
        "l_quantity as latency_seconds",
    )


@query
def window_report(t):
    return reports.match_report(_matches(t))


@query
def window_report_by_item(t):
    return reports.match_report_by_item(_matches(t))


@query
def identified_tracks(t):
    return reports.identified_tracks(_matches(t))


@query
def transcript_methods(t):
    rows = ingest.transcript_rows(t.transcript_attempts, now())
    attempts = rows.select(
        F.col("source").alias("method"), F.col("text").isNotNull().alias("success"),
        (F.coalesce("char_count", F.lit(0)) / 1000).alias("latency_seconds"), "word_count",
    )
    return reports.method_summary(attempts)


# --- streams ----------------------------------------------------------------------


@query
def daily_counters_stream(t):
    """Event counts kept by the stream, read back from its table."""
    base = scratch_path(t.spark, "events")
    # a file stream wants a folder or a pattern
    stream.ingest_events(
        t.spark, f"{t.root}/event[s].parquet", f"{base}/table", f"{base}/state"
    ).awaitTermination()
    return stream.counts_table(t.spark, f"{base}/table").read()


@query
def daily_counters_out_of_order(t):
    """The same from a file per slice of days, the newest first, one file a batch."""
    base = scratch_path(t.spark, "late-events")
    events = t.raw("events")
    # the stream takes files by age: write the newest days first, a slice that splits days across files last
    slices = ["day(ts) > 20", "day(ts) between 11 and 20", "day(ts) <= 10 and event_id % 2 = 0", "day(ts) <= 10 and event_id % 2 = 1"]
    for part in slices:
        events.filter(part).coalesce(1).write.mode("append").parquet(f"{base}/in")
    stream.ingest_events(t.spark, f"{base}/in", f"{base}/table", f"{base}/state", files_per_batch=1).awaitTermination()
    return stream.counts_table(t.spark, f"{base}/table").read()


@query
def merge_repeated_keys(t):
    """Events as keyed rows, every key many times over and merged twice: one row per key, the greatest one."""
    rows = t.raw("events").selectExpr("user_id as k", "event_id as at", "event_type as kind")
    target = rows.filter("k % 2 = 0").dropDuplicates(["k"]).selectExpr("k", "cast(-1 as bigint) as at", "'none' as kind")
    return upsert(upsert(target, rows, ["k"]), rows, ["k"])


@query
def snapshots_stream(t):
    """Snapshots ingested from files twice over; the second pass changes nothing."""
    base = scratch_path(t.spark, "snapshots")
    t.snapshots.write.parquet(f"{base}/in")
    for state in ("a", "b"):
        stream.ingest_snapshots(
            t.spark, f"{base}/in", f"{base}/table", f"{base}/{state}"
        ).awaitTermination()
    stored = tables.day_table(t.spark, f"{base}/table", "counter_snapshots").read()
    return stored.select("item_id", "view_count", "like_count", "comment_count", "collected_date")
