"""One folder of tables, the read queries over it, and the daily jobs that maintain it."""

from __future__ import annotations

import json
from dataclasses import dataclass
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.operators.upsert import upsert
from crestline.plans import findings, ingest, metrics, predictions, reads, scores, scoring, series, training, trends
from crestline.schemas import SNAPSHOT_KINDS, TABLES, TRANSCRIPT_SOURCES
from crestline.session import pin, stored
from crestline.sources import seeds, sinks
from crestline.sources.daytable import DayTable
from crestline.sources.tables import day_table, floor_for, read_current, read_labels, write_current


@dataclass
class Workspace:
    """Tables below ``root``, seen as of one day.

    Day-partitioned tables are read down to their floor; a merge rewrites the days it
    touches and switches to them in one step. The others are replaced version by version.
    """

    spark: SparkSession
    root: str
    as_of: date

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def table(self, name: str) -> DataFrame:
        if TABLES[name].partition is None:
            return read_current(self.spark, self.path(name), name)
        return self.days(name).read(since=floor_for(name, self.as_of))

    def days(self, name: str) -> DayTable:
        return day_table(self.spark, self.path(name), name)

    def replace(self, name: str, df: DataFrame) -> None:
        write_current(df.select(*TABLES[name].columns), self.path(name))

    def counters(self, days: int) -> DataFrame:
        """Snapshots that settle any question about the last ``days`` days: those days and a seed row per item."""
        name = "counter_snapshots"
        return seeds.recent(self.days(name), self.as_of - timedelta(days=days), floor_for(name, self.as_of))

    def merge(self, name: str, staged: DataFrame, seq: str | None = None) -> None:
        if name == "counter_snapshots":
            seeds.merge_counters(self.days(name), staged, TABLES[name].keys, seq)
            return
        self.days(name).merge(staged, TABLES[name].keys, seq=seq)

    # --- reads --------------------------------------------------------------------

    def titled(self) -> DataFrame:
        return reads.titled_items(*(self.table(t) for t in ("items", "movies", "shows", "seasons")))

    def sequence(self, model_version: str | None = None) -> DataFrame:
        return metrics.current_sequence(self.table("scores"), self.table("items"), self.as_of, model_version)

    def search_items(self, **filters) -> DataFrame:
        return reads.find_items(*(self.table(t) for t in ("items", "movies", "shows", "seasons")), **filters)

    def item_metrics(self, item_id: str, days: int = 30) -> DataFrame:
        return reads.item_metrics(self.counters(days), self.table("items"), self.as_of, item_id, days)

    def top_comments(self, item_id: str | None = None, snapshot_kind: str | None = None, limit: int = 30) -> DataFrame:
        return reads.top_comments(self.table("comments"), self.as_of, item_id, snapshot_kind, limit)

    def trending(self, period_days: int = reads.TRENDING_DAYS, **options) -> DataFrame:
        return reads.trending(*self._for_trending(period_days), self.as_of, period_days, **options)

    def _for_trending(self, days: int) -> list[DataFrame]:
        return [self.counters(days), *(self.table(t) for t in ("items", "movies", "shows", "seasons"))]

    def movie_engagement_trend(self, movie_id: int | None = None, days: int = 30) -> DataFrame:
        """All movies, or one: the filter goes below the joins and windows."""
        items = self.table("items")
        if movie_id is not None:
            items = items.filter(F.col("movie_id") == movie_id)
        return trends.engagement_trend(
            self.counters(days), items, self.as_of, days, selective=movie_id is not None
        )

    def engagement_decay(self, days: int = trends.DECAY_DAYS, unit: str = "movie") -> DataFrame:
        return trends.engagement_decay(self.counters(days), self.table("items"), self.as_of, days, unit)

    def comment_excitement_decay(self, model_version: str | None = None) -> DataFrame:
        return scores.score_decay(self.sequence(model_version))

    def movie_excitement_trend(self, movie_id: int | None = None, model_version: str | None = None) -> DataFrame:
        items = self.table("items")
        if movie_id is not None:
            items = items.filter(F.col("movie_id") == movie_id)
        sequence = metrics.current_sequence(self.table("scores"), items, self.as_of, model_version)
        return scores.score_trend(sequence)

    def interesting_findings(self, days: int = 30, top: int | None = 6) -> DataFrame:
        return findings.detect_findings(
            self.counters(max(days, findings.FATIGUE_PEAK_DAYS)), self.table("items"), self.table("movies"), self.as_of,
            self.sequence(), days, top,
        )

    def prediction_track_record(self) -> DataFrame:
        return predictions.track_record(self.table("predictions"))

    def open_predictions(self) -> DataFrame:
        return predictions.open_predictions(self.table("predictions"))

    def country_stats(self) -> DataFrame:
        return reads.country_stats(self.table("items"), self.table("movies"), self.table("shows"))

    # --- documents ------------------------------------------------------------------

    def write_site(self, out: str, generated_at: datetime, days: int = trends.DECAY_DAYS, unit: str = "movie") -> DataFrame:
        """Publish the read-only documents: a new folder, switched to as a whole."""
        stats, items, movies = (self.table(t) for t in ("counter_snapshots", "items", "movies"))
        latest = metrics.latest_version(self.table("scores"), self.as_of).first()
        version = F.lit(latest and latest[0]).alias("model_version")
        builders = {
            "carousel": lambda: reads.carousel(*self._for_trending(reads.CAROUSEL_DAYS), self.as_of),
            "excitement_decay": lambda: sinks.by_bucket(
                self.comment_excitement_decay(), "by_movie_item_count", model_version=version
            ),
            "excitement_examples": lambda: scores.score_examples(
                self.table("scores"), items, movies, self.as_of
            ).select(version, "*"),
            "views_timeseries": lambda: series.view_timeseries(stats, items, movies, self.as_of).select(
                F.lit(series.WINDOW_DAYS).alias("window_days"), "*"
            ),
            "engagement_decay": lambda: sinks.by_bucket(
                self.engagement_decay(days, unit), "by_movie_item_count", unit=F.lit(unit), days=F.lit(days)
            ),
            "coverage": lambda: reads.coverage_document(self.country_stats(), items),
            "mcp_examples": lambda: sinks.trimmed(self.search_items(limit=5)),
        }
        meta = {"model_version": latest and latest[0], "period_days": reads.CAROUSEL_DAYS, "dataset": self.root}
        return sinks.write_site(self.spark, out, builders, generated_at, meta)

    # --- daily jobs -----------------------------------------------------------------
    # Every job returns the counts of what it did, taken while its rows were stored; a job's first
    # count is its number of processed items.

    def collect_counters(self, documents: DataFrame, now: Column) -> dict[str, int]:
        """Merge today's counters; documents that cannot be booked go to the rejects table."""
        tally, good = sinks.Tally(), F.col("reason").isNull()
        metrics = {
            "documents": {"counted": F.count_if(good), "rejected": F.count_if(~good)},
            "unavailable": {"unavailable": F.count("*")},
        }
        run = ingest.counter_run(
            self.table("items"), self.table("counter_snapshots"), documents, self.as_of, now,
            hold=lambda name, df: tally.hold(df, **metrics[name]),
        )
        self.merge("counter_snapshots", run.counters)
        self.merge("rejects", run.rejects)
        self.replace("items", run.items)
        return tally.counts

    def collect_comments(self, threads: DataFrame, now: Column) -> dict[str, int]:
        run = ingest.comment_run(self.table("items"), self.table("comments"), threads, self.as_of, now)
        tally, state, kind = sinks.Tally(), F.col("state"), F.col("snapshot_kind")
        captured = tally.hold(run.captured, comments=F.count("*"))
        tally.hold(
            run.outcomes,
            **{k: F.count_if((state == "ok") & (kind == k)) for k in SNAPSHOT_KINDS},
            disabled=F.count_if(state == "disabled"), failed=F.count_if(state == "failed"),
        )
        self.merge("comments", captured.withColumn("_seq", F.col("rank")), seq="_seq")
        self.replace("items", run.items)
        return tally.counts

    def discover(self, listings: DataFrame, kind: str, now: Column) -> dict[str, int]:
        """Bring titles, items, providers and credits up to date; each document is read and parsed once."""
        tally = sinks.Tally()

        def hold(_: str, df: DataFrame) -> DataFrame:
            return tally.hold(df, documents=F.count("*"))

        if kind == "movie":
            found = ingest.discover_movies(listings, now, hold)
        else:
            found = ingest.discover_tv(listings, self.as_of, now, hold)
        items = tally.hold(found.items, items=F.count("*"))
        self.replace("items", ingest.merge_discovered_items(self.table("items"), items))
        parts = {"movies" if kind == "movie" else "shows": found.titles, "providers": found.providers,
                 "credits": found.credits}
        if found.seasons is not None:
            parts["seasons"] = found.seasons
        for name, rows in parts.items():
            held = tally.hold(rows, **{name: F.count("*")})
            self.replace(name, upsert(self.table(name), held, TABLES[name].keys))
        return {"items": tally.counts["items"], **tally.counts}

    def score_comments(self, embedded: DataFrame, head: scoring.LinearHead, now: Column, dim: int) -> dict[str, int]:
        rows = scoring.candidate_scores(embedded, self.table("scores"), head, self.as_of, now, dim)
        tally, has = sinks.Tally(), F.col("excitement").isNotNull()
        held = tally.hold(rows, scored=F.count_if(has), skipped=F.count_if(~has))
        self.merge("scores", held.filter(has))
        return tally.counts

    def capture_transcripts(
        self, attempts: DataFrame, now: Column, limit: int | None = None
    ) -> dict[str, int]:
        tally, source = sinks.Tally(), F.col("source")
        merged, items = ingest.transcript_run(
            self.table("items"), self.table("transcripts"), attempts, now, limit,
            hold=lambda _, df: tally.hold(
                df, attempted=F.count("*"), **{s: F.count_if(source == s) for s in TRANSCRIPT_SOURCES}
            ),
        )
        self.replace("transcripts", merged)
        self.replace("items", items)
        return tally.counts

    def update_predictions(self, now: Column, top: int | None = None) -> dict[str, int]:
        found = pin(self.interesting_findings(top=top))
        log, tally, status = self.table("predictions"), sinks.Tally(), F.col("status")
        changes = tally.hold(
            predictions.daily_changes(log, self.table("items"), found, self.as_of, now),
            opened=F.count_if(status == "open"), hits=F.count_if(status == "hit"), misses=F.count_if(status == "miss"),
        )
        self.replace("predictions", upsert(log, changes, TABLES["predictions"].keys))
        return tally.counts

    # --- heads ----------------------------------------------------------------------

    def train_head(self, labels: str, embedded: DataFrame, version: str, now: Column, dim: int) -> DataFrame:
        """Labels file to features to head to gate; returns the head's registry row.

        The head, its out-of-fold quality and every gate check are kept under its version. It becomes
        the current one if all checks pass; otherwise the current one stays.
        """
        comments = scoring.discovery_comments(embedded, self.as_of)
        links = metrics.movie_links(self.table("items"))
        row = training.trained_head(
            comments, read_labels(self.spark, labels), links, version, scoring.feature_layout(dim), now
        )
        row = stored(row, "head")
        self.replace("heads", upsert(self.table("heads"), row, TABLES["heads"].keys))
        return row

    def current_head(self, dim: int) -> scoring.LinearHead:
        """The newest head that passed its gate, for features of ``dim`` embedding dimensions."""
        passed = self.table("heads").filter("passed").orderBy(F.desc("trained_at"), F.desc("version")).take(1)
        if not passed:
            raise LookupError("no trained head has passed its gate")
        r = passed[0]
        head = scoring.LinearHead(r.version, r.coef, r.intercept, r.mean, r.scale, r.layout)
        head.check(scoring.feature_layout(dim))
        return head

    def append_run_log(self, log: sinks.RunLog) -> None:
        self.replace("run_log", log.merged_into(self.table("run_log")))

    def run_day(
        self,
        at: datetime,
        movie_listings: DataFrame | None = None,
        tv_listings: DataFrame | None = None,
        documents: DataFrame | None = None,
        threads: DataFrame | None = None,
        embedded: DataFrame | None = None,
        head: scoring.LinearHead | None = None,
        dim: int = 0,
        attempts: DataFrame | None = None,
        predict: bool = True,
        run_id: str | None = None,
    ) -> DataFrame:
        """All phases that have input, in their fixed order; returns this run's log rows.

        Without ``head`` comments are scored by the current one. A failing phase ends the run; the
        log is kept either way.
        """
        now = F.lit(at)
        log = sinks.RunLog(self.spark, run_id)
        phases = [
            ("discover_movies", movie_listings,
             lambda: self.discover(movie_listings, "movie", now)),
            ("discover_tv", tv_listings,
             lambda: self.discover(tv_listings, "tv", now)),
            ("stats", documents, lambda: self.collect_counters(documents, now)),
            ("comments", threads, lambda: self.collect_comments(threads, now)),
            ("excitement", embedded, lambda: self.score_comments(embedded, head or self.current_head(dim), now, dim)),
            ("transcripts", attempts, lambda: self.capture_transcripts(attempts, now)),
            ("predictions", predict or None, lambda: self.update_predictions(now)),
        ]
        try:
            for name, given, job in phases:
                if given is not None:
                    with log.phase(name) as ctx:
                        counts = job()
                        ctx["items_processed"], ctx["notes"] = next(iter(counts.values())), json.dumps(counts)
        finally:
            self.append_run_log(log)
        return log.rows()
