import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from crestline.catalog.queries import shaped
from crestline.plans import scoring, training
from crestline.schemas import TABLES
from crestline.sources import sinks, tables
from crestline.sources.manifest import Manifest, WriteConflict
from crestline.sources.testbed import AS_OF, NOW, Testbed
from crestline.streaming import counters as stream
from crestline.workspace import Workspace

ROOT = "/root/testdata/sf0.001"


def now():
    return F.lit(NOW).cast("timestamp")


def test_every_table_declares_its_columns(spark):
    for name, spec in TABLES.items():
        assert spec.columns == spark.createDataFrame([], spec.ddl).columns, name
        assert set(spec.keys) <= set(spec.columns) and (spec.partition or spec.columns[0]) in spec.columns


def test_partitioned_scan_needs_and_prunes_by_a_bound(spark, tmp_path):
    path = str(tmp_path / "snaps")
    tables.save(Testbed(spark, ROOT).snapshots, path, "counter_snapshots")
    with pytest.raises(ValueError):
        tables.scan(spark, path, "counter_snapshots")
    df = tables.scan(spark, path, "counter_snapshots", since=F.lit("2024-01-28").cast("date")).select("item_id", "view_count")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(collected_date" in plan and "2024-01-28" in plan
    assert "ReadSchema: struct<item_id:string,view_count:bigint>" in plan
    assert 0 < df.count() < Testbed(spark, ROOT).snapshots.count()


def test_parametrised_sql(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    got = tables.query(spark, "select s from {t} where id >= :low", {"t": df}, low=2).collect()
    assert [r.s for r in got] == ["b"]


def test_labels(spark, tmp_path):
    path = tmp_path / "labels.jsonl"
    path.write_text('{"item_id":"a","excitement":40}\nnot json\n{"item_id":"b"}\n')
    assert [(r.item_id, r.excitement) for r in tables.read_labels(spark, str(path)).collect()] == [("a", 40.0)]


def test_training_export_is_one_object_per_item(spark, tmp_path):
    bed, out = Testbed(spark, ROOT), str(tmp_path / "set")
    sets = scoring.comment_sets(scoring.discovery_comments(bed.comments, AS_OF))
    rows = sinks.training_set(sets, bed.items, bed.movies)
    sinks.export_training_set(rows, out)
    back = spark.read.json(out)
    assert back.count() == rows.count() > 0
    first = back.orderBy("item_id").first()
    assert len(first.comments) >= 3 and first.comments[0].rank == min(c.rank for c in first.comments)


def test_versions_are_replaced_only_when_complete(spark, tmp_path):
    base = str(tmp_path / "run_log")
    assert tables.read_current(spark, base, "run_log").count() == 0
    log = sinks.RunLog(spark, "r1")
    with log.phase("stats") as ctx:
        ctx["items_processed"] = 3
    tables.write_current(log.rows(), base)
    log.rows().limit(0).write.parquet(f"{base}/data/died")  # a write that never switched
    assert [r.items_processed for r in tables.read_current(spark, base, "run_log").collect()] == [3]


def test_old_versions_go_and_a_second_writer_fails(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "run_log")
    rows = sinks.RunLog(spark, "r1").rows()
    assert [tables.write_current(rows, base, keep=2) for _ in range(4)] == [1, 2, 3, 4]
    assert len(list((tmp_path / "run_log" / "data").iterdir())) == 2
    with monkeypatch.context() as m, pytest.raises(WriteConflict):
        m.setattr(Manifest, "load", lambda self, version=None: (3, None))  # read before the fourth write
        tables.write_current(rows, base)
    assert len(list((tmp_path / "run_log" / "data").iterdir())) == 2
    assert tables.read_current(spark, base, "run_log").count() == 0


def test_run_log_keeps_failed_phases(spark):
    log = sinks.RunLog(spark, "r1")
    with pytest.raises(KeyError), log.phase("comments"):
        raise KeyError("x")
    row = log.rows().first()
    assert (row.phase, row.errors, row.items_processed) == ("comments", 1, None)
    twice = log.merged_into(log.merged_into(spark.createDataFrame([], TABLES["run_log"].ddl)))
    assert twice.count() == 1


def test_observed_counts_come_with_the_write(spark, tmp_path):
    df, watch = sinks.observed(spark.range(7), "seen", rows=F.count("*"))
    df.write.parquet(str(tmp_path / "x"))
    assert watch.get["rows"] == 7


def test_json_rows_keep_nulls_and_iso_times(spark):
    df = spark.sql("select 1 a, cast(null as string) b, date'2024-01-02' d, timestamp'2024-01-02 03:04:05' t, array(date'2024-01-01') l")
    assert json.loads(sinks.as_json(df).first()[0]) == {
        "a": 1, "b": None, "d": "2024-01-02", "t": "2024-01-02T03:04:05Z", "l": ["2024-01-01"],
    }


def test_trimmed_previews(spark):
    df = spark.sql("select sequence(1, 9) xs, repeat('x', 300) text, repeat('y', 300) note")
    r = sinks.trimmed(df).first()
    assert (len(r.xs), len(r.text), len(r.note)) == (5, 201, 300)


def test_trimmed_previews_at_any_depth(spark):
    df = spark.sql("select array_repeat(named_struct('text', repeat('x', 300), 'ids', sequence(1, 9), 'n', null), 7) items,"
                   " named_struct('inner', named_struct('text', 'short', 'deep', array_repeat(sequence(1, 8), 6))) box,"
                   " cast(null as struct<text string>) none")
    r = sinks.trimmed(df).first()
    assert len(r["items"]) == 5 and {(len(i.text), len(i.ids)) for i in r["items"]} == {(201, 5)}
    assert r.box.inner.text == "short" and [len(x) for x in r.box.inner.deep] == [5] * 5 and r.none is None


# --- streams ------------------------------------------------------------------------


def test_snapshot_stream_is_idempotent_and_takes_late_days(spark, frame, rows, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    ddl = TABLES["counter_snapshots"].ddl

    def arrive(*data):
        frame(ddl, *data).coalesce(1).write.mode("append").parquet(src)
        stream.ingest_snapshots(spark, src, out, state).awaitTermination()
        return rows(tables.day_table(spark, out, "counter_snapshots").read(), "item_id", "collected_date", "view_count")

    d1, d2 = date(2024, 1, 1), date(2024, 1, 2)
    arrive(("a", "2024-01-02", 5, 0, 0, 0, "2024-01-02 01:00:00"), ("a", "2024-01-02", 7, 0, 0, 0, "2024-01-02 02:00:00"))
    got = arrive(("a", "2024-01-01", 3, 0, 0, 0, "2024-01-03 00:00:00"), ("b", "2024-01-02", 1, 0, 0, 0, "2024-01-02 00:00:00"))
    assert got == [("a", d1, 3), ("a", d2, 7), ("b", d2, 1)]
    # the same files again through a fresh state
    stream.ingest_snapshots(spark, src, out, str(tmp_path / "state2")).awaitTermination()
    assert rows(tables.day_table(spark, out, "counter_snapshots").read(), "item_id", "collected_date", "view_count") == got


def test_event_stream_updates_counts_across_batches(spark, rows, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    events = spark.read.parquet(f"{ROOT}/events.parquet")
    for part in ("ts < '2024-01-10 12:00:00'", "ts >= '2024-01-10 12:00:00'"):
        events.filter(part).coalesce(1).write.mode("append").parquet(src)
        stream.ingest_events(spark, src, out, state).awaitTermination()
    got = stream.counts_table(spark, out).read()
    want = events.groupBy(F.concat(F.lit("v"), "user_id").alias("item_id"), F.to_date("ts").alias("day")).agg(
        F.count("*").alias("views"), F.count_if(F.col("event_type") == "click").alias("likes")
    )
    assert rows(got, "item_id", "day", "views", "likes") == rows(want, "item_id", "day", "views", "likes")


def test_events_are_counted_in_any_order_of_arrival(spark, rows, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))

    def arrive(*events):
        df = spark.createDataFrame([(i, at, 1, "view", 0.0, "") for i, at in events],
                                   "event_id long, ts string, user_id long, event_type string, value double, props string")
        df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(src)
        stream.ingest_events(spark, src, out, state, files_per_batch=1).awaitTermination()
        return rows(stream.counts_table(spark, out).read(), "day", "views")

    d1, d8, d9 = date(2024, 1, 1), date(2024, 1, 8), date(2024, 1, 9)
    assert arrive((2, "2024-01-09 10:00:00")) == [(d9, 1)]
    assert arrive((1, "2024-01-01 10:00:00"), (5, "2024-01-08 23:59:59")) == [(d1, 1), (d8, 1), (d9, 1)]
    assert arrive((3, "2024-01-01 11:00:00"), (4, "2024-01-09 00:00:00")) == [(d1, 2), (d8, 1), (d9, 2)]


# --- a day in a workspace -----------------------------------------------------------


@pytest.fixture(scope="module")
def workspace(spark, tmp_path_factory):
    bed = Testbed(spark, ROOT)
    ws = Workspace(spark, str(tmp_path_factory.mktemp("ws")), date.fromisoformat(AS_OF))

    def shaped(df, name):
        schema = spark.createDataFrame([], TABLES[name].ddl).schema
        return df.select(*[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
        ])

    for name, df in (("items", bed.items), ("movies", bed.movies), ("shows", bed.shows), ("seasons", bed.seasons),
                     ("predictions", bed.predictions)):
        ws.replace(name, shaped(df, name))
    for name, df in (("counter_snapshots", bed.snapshots), ("comments", bed.comments), ("scores", bed.scores)):
        tables.save(shaped(df, name), ws.path(name), name)
    return ws, bed


def test_reads_over_a_workspace(workspace, rows):
    ws, _ = workspace
    assert ws.trending(limit=5).count() == 5
    assert ws.search_items(content_kind="movie", limit=3).count() == 3
    assert ws.item_metrics("v7").count() > 20
    assert ws.top_comments("v3").count() > 0
    one = ws.movie_engagement_trend(2)
    assert one.count() == 1
    assert rows(one) == rows(ws.movie_engagement_trend().filter("movie_id = 2"))
    assert ws.engagement_decay(unit="item").count() == 4
    assert ws.comment_excitement_decay().first().movies > 0
    assert ws.movie_excitement_trend(4).count() == 1
    assert ws.interesting_findings(top=3).count() == 3
    assert ws.prediction_track_record().first().open == ws.open_predictions().count()


def test_daily_jobs_and_documents(spark, workspace, tmp_path):
    ws, bed = workspace
    before = ws.table("counter_snapshots").count()
    counts = ws.collect_counters(bed.video_documents, now())
    n = counts["counted"]
    assert counts["rejected"] == 0 and counts["unavailable"] > 0
    again = ws.table("counter_snapshots").count()
    assert 0 < n and before <= again <= before + n
    ws.collect_counters(bed.video_documents, now())
    assert ws.table("counter_snapshots").count() == again
    counts = ws.collect_comments(bed.item_threads, now())
    assert counts["comments"] > 0 and counts["disabled"] > 0 and counts["failed"] > 0
    assert ws.table("items").filter("comments_disabled").count() > bed.items.filter("comments_disabled").count()
    open_before = ws.open_predictions().count()
    counts = ws.update_predictions(now())
    assert counts["hits"] > 0 and counts["misses"] > 0
    assert ws.open_predictions().count() < open_before
    counts = ws.capture_transcripts(bed.transcript_attempts, now())
    assert counts["attempted"] == counts["yta"] + counts["whisper"] + counts["failed"] == ws.table("transcripts").count()
    assert ws.table("transcripts").count() > 0

    out = str(tmp_path / "site")
    report = {r.name: r.error for r in ws.write_site(out, datetime(2024, 1, 30, tzinfo=timezone.utc)).collect()}
    assert set(report) == {*sinks.SITE_DOCUMENTS, "meta"} and not any(report.values())
    coverage = spark.read.json(sinks.site_path(spark, out, "coverage")).first()
    assert coverage.unique_items == 150 and len(coverage.top_countries) == 8
    totals = [c.total_items for c in coverage.top_countries]
    assert totals == sorted(totals, reverse=True)
    assert spark.read.json(sinks.site_path(spark, out, "meta")).first().model_version == "m2"
    decay = spark.read.json(sinks.site_path(spark, out, "engagement_decay")).first()
    assert (decay.unit, decay.days) == ("movie", 45) and decay.by_movie_item_count["4+"].units > 0
    # a second version replaces the first as a whole
    before = sinks.site_path(spark, out, "coverage")
    ws.write_site(out, datetime(2024, 1, 31, tzinfo=timezone.utc), days=20, unit="item")
    assert sinks.site_path(spark, out, "coverage") != before
    decay = spark.read.json(sinks.site_path(spark, out, "engagement_decay")).first()
    assert (decay.unit, decay.days) == ("item", 20)


def test_a_whole_day_is_logged_in_order(spark, tmp_path):
    bed = Testbed(spark, ROOT)
    ws = Workspace(spark, str(tmp_path / "ws"), date.fromisoformat(AS_OF))
    at = datetime(2024, 1, 30, 6)
    log = ws.run_day(at, bed.movie_listings, bed.tv_listings, documents=bed.video_documents, run_id="r1")
    got = {r.phase: (r.items_processed, r.errors) for r in log.collect()}
    assert list(got) == ["discover_movies", "discover_tv", "stats", "predictions"]
    assert got["discover_movies"][0] > 100 and got["stats"] == (0, 0)  # none of the documents is of these items
    assert ws.table("items").filter("content_kind = 'tv'").count() == got["discover_tv"][0]
    assert ws.table("credits").count() > 0 and ws.table("seasons").count() > 0
    with pytest.raises(LookupError):
        ws.run_day(at, embedded=bed.embedded_comments, head=None, run_id="r2")
    stored = {(r.run_id, r.phase): r.errors for r in ws.table("run_log").collect()}
    assert stored[("r2", "excitement")] == 1 and len(stored) == 5


def test_a_failing_section_leaves_its_empty_document(spark, tmp_path):
    def broken():
        raise RuntimeError("no scores")

    out = str(tmp_path / "site")
    builders = {"coverage": lambda: spark.sql("select 1 x"), "carousel": broken}
    report = {r.name: r.error for r in sinks.write_site(spark, out, builders, datetime(2024, 1, 30), {"period_days": 30}).collect()}
    assert report["coverage"] is None and report["carousel"] == "no scores" and report["meta"] is None
    assert spark.read.text(sinks.site_path(spark, out, "carousel")).first()[0] == "[]"
    assert spark.read.text(sinks.site_path(spark, out, "excitement_examples")).first()[0] == '{"examples":[]}'
    with pytest.raises(FileNotFoundError):
        sinks.site_path(spark, str(tmp_path / "elsewhere"), "carousel")


def test_a_trained_head_scores_once_it_has_passed(spark, tmp_path, monkeypatch):
    bed = Testbed(spark, ROOT)
    ws = Workspace(spark, str(tmp_path / "ws"), date.fromisoformat(AS_OF))
    ws.replace("items", shaped(bed.items, "items"))
    path = str(tmp_path / "labels")
    bed.raw("embeddings").selectExpr("to_json(struct(concat('v', vec_id) as item_id, label * 10D as excitement))").write.text(path)
    gate = "named_struct('check', 'any', 'value', 1D, 'passed', {0}) x"
    for version, passes in (("h1", "true"), ("h2", "false")):
        outcome = spark.range(1).selectExpr(gate.format(passes)).select("x.*")
        monkeypatch.setattr(training, "acceptance_gate", lambda rows, outcome=outcome: outcome)
        row = ws.train_head(path, bed.embedded_comments, version, now() + F.expr(f"interval {version[1]} hours"), 64).first()
        assert row.passed == (passes == "true") and row.n > 10 and len(row.coef) == 67
    assert ws.current_head(64).version == "h1"  # the later one failed
    with pytest.raises(ValueError):
        ws.current_head(32)
    log = ws.run_day(datetime(2024, 1, 30, 6), embedded=bed.embedded_comments, dim=64, predict=False, run_id="r1").first()
    counts = json.loads(log.notes)
    assert counts["scored"] == log.items_processed > 0
    assert {r.model_version for r in ws.table("scores").collect()} == {"h1"}
