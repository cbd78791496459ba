import json
import re

import pytest
from pyspark.sql import functions as F

from crestline.catalog.queries import QUERIES
from crestline.plans import ingest
from crestline.schemas import TABLES, violations
from crestline.session import stored
from crestline.sources import payloads as raw
from crestline.sources import testbed
from crestline.sources.testbed import Testbed

TODAY = "2024-01-30"
NOW = "2024-01-30 06:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


def items_table(spark, *overrides):
    base = {
        "content_kind": "movie", "movie_id": 1, "video_type": "Trailer", "tracking_status": "active",
        "comments_disabled": False, "first_seen_at": "2024-01-01 00:00:00",
    }
    schema = spark.createDataFrame([], TABLES["items"].ddl).schema
    plain = ", ".join(
        f"{f.name} {'string' if f.dataType.typeName() in ('date', 'timestamp') else f.dataType.simpleString()}"
        for f in schema
    )
    data = [tuple({**base, **o}.get(f.name) for f in schema) for o in overrides]
    df = spark.createDataFrame(data, plain)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def doc(item_id, **parts):
    return (item_id, json.dumps({"id": item_id, **parts}))


def docs(spark, *d):
    return spark.createDataFrame(list(d), "item_id string, payload string")


# --- documents --------------------------------------------------------------------


def test_counters_arrive_as_text(spark):
    d = docs(spark, doc("a", statistics={"viewCount": "12", "likeCount": "x", "commentCount": None}), doc("b"))
    got = {r.item_id: (r.view_count, r.like_count, r.comment_count) for r in raw.counter_rows(d, TODAY, now()).collect()}
    assert got == {"a": (12, None, None), "b": (None, None, None)}


def test_comment_text_falls_back_and_rank_is_the_position(spark):
    threads = [
        {"id": "c1", "snippet": {"totalReplyCount": 2, "topLevelComment": {"snippet": {
            "textDisplay": "", "textOriginal": "plain", "likeCount": 3, "authorChannelId": {"value": "u"},
            "publishedAt": "2024-01-02T03:04:05Z"}}}},
        {"id": "c2", "snippet": {"topLevelComment": {"snippet": {"textDisplay": "shown"}}}},
    ]
    df = spark.createDataFrame([("a", "at_discovery", json.dumps(threads))], "item_id string, snapshot_kind string, payload string")
    a, b = raw.comment_rows(df, TODAY, now()).orderBy("rank").collect()
    assert (a.text, a.rank, a.like_count, a.total_reply_count, a.author_channel_id) == ("plain", 1, 3, 2, "u")
    assert (b.text, b.rank, b.like_count) == ("shown", 2, None)


def titles(spark, details):
    df = spark.createDataFrame([(7, "movie", json.dumps(details))], "title_id bigint, content_kind string, j string")
    return raw.parse(df, "j", raw.MOVIE_DETAILS, "d")


def test_providers_come_per_region_and_offer_kind(spark):
    offers = {"AT": {"link": "at", "buy": [{"provider_id": 31, "provider_name": "Kino"}, {"provider_id": 31, "provider_name": "Kino+"}],
                     "rent": [{"provider_id": 31}]},
              "BR": {"link": "br", "flatrate": [{"provider_name": "nameless"}, {"provider_id": 0}]}}
    rows = raw.provider_rows(titles(spark, {"watch/providers": {"results": offers}}), now())
    assert sorted((r.region, r.kind, r.provider_id, r.seq) for r in rows.collect()) == [
        ("AT", "buy", 31, 0), ("AT", "buy", 31, 1), ("AT", "rent", 31, 0)
    ]
    assert raw.provider_rows(titles(spark, {}), now()).count() == 0


def test_a_repeated_provider_is_one_row_and_merging_it_again_adds_none(spark):
    details = {"title": "A", "watch/providers": {"results": {"AT": {"link": "l", "buy": [
        {"provider_id": 31, "provider_name": "old"}, {"provider_id": 31, "provider_name": "new"}]}}}}
    listings = spark.createDataFrame(
        [(0, 0, 5, "", json.dumps(details), "[]")],
        "region_order int, position int, movie_id bigint, listed_release_date string, details string, videos string",
    )
    rows = ingest.discover_movies(listings, now()).providers
    table = spark.createDataFrame([], TABLES["providers"].ddl)
    for _ in range(2):
        table = ingest.upsert(table, rows, TABLES["providers"].keys)
    assert [r.provider_name for r in table.collect()] == ["new"]  # the last listing stands


def test_credits_rank_cast_and_join_the_jobs_of_a_person(spark):
    cast = [{"id": 500 + i, "name": f"p{i}", "order": i % 6} for i in range(12)] + [{"name": "nobody"}]
    crew = [{"id": 7, "name": "Ada", "job": "Producer", "department": "P"}, {"id": 8, "name": "Bo", "job": "Gaffer"},
            {"id": 7, "name": "A.", "job": "Director", "department": "Q"}]
    got = raw.credit_rows(titles(spark, {"credits": {"cast": cast, "crew": crew}}), now()).collect()
    ranked = [r.person_id for r in sorted((r for r in got if r.credit_kind == "cast"), key=lambda r: r.order_index)]
    assert ranked == [500, 506, 501, 507, 502, 508, 503, 509, 504, 510]  # by order, then as listed
    assert [(r.person_id, r.name, r.job, r.department) for r in got if r.credit_kind == "crew"] == [(7, "Ada", "Director, Producer", "P")]


# --- discovery ----------------------------------------------------------------------


def video(key, name="Cut", kind="Trailer", site="YouTube"):
    return {"key": key, "site": site, "type": kind, "name": name, "published_at": "2024-01-02T00:00:00.000Z", "official": True}


@pytest.fixture(params=["planned on its own", "documents stored"])
def hold(request):
    return None if request.param == "planned on its own" else lambda name, df: stored(df, name)


def test_movie_discovery(spark, hold):
    ddl = "region_order int, position int, movie_id bigint, listed_release_date string, details string, videos string"
    details = json.dumps({"title": "A", "genres": [{"id": 1}], "production_countries": [{"iso_3166_1": "US"}]})
    listings = spark.createDataFrame(
        [(1, 0, 5, "2024-09-09", json.dumps({"title": "later region"}), "[]"),
         (0, 3, 5, "2024-05-01", details, json.dumps([video("v1"), video("v2", kind="Clip"), video("v1", "Official Trailer")])),
         (0, 4, 6, "2024-05-01", None, json.dumps([video("lost")])),
         (0, 5, 8, "", details, None)],
        ddl,
    )
    found = ingest.discover_movies(listings, now(), hold)
    movies = {r.movie_id: r for r in found.titles.collect()}
    assert set(movies) == {5, 8}
    assert (movies[5].title, str(movies[5].release_date), movies[5].origin_countries) == ("A", "2024-05-01", ["US"])
    assert movies[5].genres[0].name == "" and movies[8].release_date is None
    item = found.items.collect()
    # the later listing of the same video stands
    assert [(r.item_id, r.video_type, str(r.tracking_end_date)) for r in item] == [("v1", "Official Trailer", "2024-05-01")]
    assert violations(found.items, "items").count() == 0


def test_a_season_listed_twice_counts_as_last_listed(spark, hold):
    details = json.dumps({"name": "S", "seasons": [
        {"season_number": 2, "air_date": "2024-03-01", "name": "first"}, {"season_number": 2, "air_date": "2024-05-01", "name": "last"},
        {"season_number": 3, "air_date": "2024-06-01"}, {"season_number": 3, "air_date": "2020-01-01"}]})
    listings = spark.createDataFrame(
        [(0, 0, 9, "2024-02-02", details, json.dumps([{"season_number": 2, "videos": [video("k")]}]), "[]")],
        "region_order int, position int, tv_id bigint, listed_first_air_date string, details string,"
        " season_videos string, series_videos string",
    )
    found = ingest.discover_tv(listings, TODAY, now(), hold)
    assert [(r.season_number, r.name) for r in found.seasons.collect()] == [(2, "last")]
    assert [(r.item_id, str(r.tracking_end_date)) for r in found.items.collect()] == [("k", "2024-05-01")]


def test_tv_discovery_anchors_series_videos(spark, hold):
    details = json.dumps({
        "name": "S", "origin_country": ["KR", ""],
        "seasons": [{"season_number": 0, "air_date": "2030-01-01"}, {"season_number": 1, "air_date": "2023-01-01"},
                    {"season_number": 2, "air_date": None}, {"season_number": 3, "air_date": "2024-06-01"},
                    {"season_number": 4, "air_date": "someday"}, {"season_number": 5, "air_date": "2024-06-01"}],
    })
    seasons = [{"season_number": 1, "videos": [video("old")]}, {"season_number": 2, "videos": [video("two"), video("both")]}]
    listings = spark.createDataFrame(
        [(0, 0, 9, "2024-02-02", details, json.dumps(seasons), json.dumps([video("both"), video("series")])),
         (0, 1, 10, "2024-02-02", json.dumps({"name": "done", "seasons": []}), "[]", json.dumps([video("none")]))],
        "region_order int, position int, tv_id bigint, listed_first_air_date string, details string,"
        " season_videos string, series_videos string",
    )
    found = ingest.discover_tv(listings, TODAY, now(), hold)
    assert {r.tv_id for r in found.titles.collect()} == {9, 10}
    assert sorted(r.season_number for r in found.seasons.collect()) == [2, 3, 5]
    got = {r.item_id: (r.season_number, str(r.tracking_end_date)) for r in found.items.collect()}
    assert got == {"two": (2, "None"), "both": (3, "2024-06-01"), "series": (3, "2024-06-01")}


def test_stored_documents_are_read_once(spark, tmp_path):
    """The job's listings may vanish once its documents are stored; repeated listings change nothing."""
    bed = Testbed(spark, "/root/testdata/sf0.001")
    path = str(tmp_path / "listings")
    bed.movie_listings.unionByName(bed.movie_listings.limit(50)).write.parquet(path)
    want = ingest.discover_movies(bed.movie_listings, now())
    found = ingest.discover_movies(spark.read.parquet(path), now(), lambda name, df: stored(df, name))
    for file in (tmp_path / "listings").glob("*.parquet"):
        file.write_bytes(b"gone")
    for name in ("titles", "items", "providers", "credits"):
        got = [sorted(map(str, getattr(f, name).collect())) for f in (found, want)]
        assert got[0] == got[1] and got[0], name


def test_first_listings_sort_no_documents_before_titles_meet(spark):
    listings = spark.createDataFrame(
        [(1, 0, 5, "later region"), (0, 3, 5, "later place"), (0, 1, 5, "first"), (0, 1, 5, "first"), (None, None, None, "unnamed"),
         (2, 2, None, "unnamed, later"), (7, 7, 6, "only")],
        "region_order int, position int, movie_id bigint, details string",
    )
    first = ingest.first_listings(listings, "movie_id")
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" not in plan and plan.count("Sort [") == 1, plan
    assert first.columns == listings.columns
    assert sorted(r.details for r in first.collect()) == ["first", "only", "unnamed"]


DOCUMENT_QUERIES = (
    "discovery_merge", "flatten_movie_items_json", "flatten_credits_json", "flatten_movies_json", "flatten_providers_json",
    "flatten_tv_items_json", "flatten_seasons_json", "flatten_shows_json",
)


@pytest.fixture
def star(spark, tmp_path):
    """Few parts and customers; part keys repeat and one is null."""
    spark.range(120).selectExpr(
        "if(id = 119, null, if(id = 118, 117, id)) as p_partkey", "concat('part ', least(id, 117)) as p_name", "'Brand#1' as p_brand",
        "'LARGE' as p_type", "cast(least(id, 117) % 50 + 1 as int) as p_size", "900D + least(id, 117) as p_retailprice",
    ).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    spark.range(40).selectExpr("id as c_custkey", "concat('c', id) as c_name", "'FURNITURE' as c_mktsegment").write.parquet(
        str(tmp_path / "customer.parquet")
    )
    return str(tmp_path)


@pytest.mark.parametrize("name", DOCUMENT_QUERIES)
def test_documents_are_flattened_in_tasks_of_so_many_titles(spark, star, monkeypatch, name):
    monkeypatch.setattr(testbed, "TITLES", 50, raising=False)
    plan = QUERIES[name](spark, star)._jdf.queryExecution().executedPlan().toString()
    assert set(re.findall(r"hashpartitioning\(p_partkey#\d+L, (\d+)\), REPARTITION_BY_NUM", plan)) == {"3"}, plan


@pytest.mark.parametrize("name", ["discovery_merge", "flatten_credits_json", "flatten_tv_items_json"])
def test_the_number_of_tasks_changes_no_row(spark, star, monkeypatch, name):
    got = []
    for titles in (50, 5_000):
        monkeypatch.setattr(testbed, "TITLES", titles, raising=False)
        got.append(sorted(map(str, QUERIES[name](spark, star).collect())))
    assert got[0] == got[1] and len(got[0]) > 40


def test_rediscovery_leaves_managed_columns_alone(spark):
    known = items_table(spark, {"item_id": "v1", "tracking_status": "ended", "name": "old", "comments_disabled": True})
    listings = spark.createDataFrame(
        [(0, 0, 5, "2024-05-01", json.dumps({"title": "A"}), json.dumps([video("v1", "new"), video("v2")]))],
        "region_order int, position int, movie_id bigint, listed_release_date string, details string, videos string",
    )
    found = ingest.discover_movies(listings, now()).items
    merged = {r.item_id: r for r in ingest.merge_discovered_items(known, found).collect()}
    old, new = merged["v1"], merged["v2"]
    assert (old.name, old.tracking_status, old.comments_disabled, old.movie_id) == ("new", "ended", True, 1)
    assert str(old.first_seen_at) == "2024-01-01 00:00:00"
    assert (new.tracking_status, new.comments_disabled, new.movie_id) == ("active", False, 5)


# --- targets and state ----------------------------------------------------------------


def ids(df):
    return [r.item_id for r in df.collect()]


def test_active_targets(spark):
    items = items_table(
        spark,
        {"item_id": "open"}, {"item_id": "grace", "tracking_end_date": "2024-01-23"},
        {"item_id": "gone", "tracking_end_date": "2024-01-22"}, {"item_id": "later", "published_at": "2024-01-31 00:00:00"},
        {"item_id": "today", "published_at": "2024-01-30 23:00:00", "tracking_end_date": "2024-02-01"},
        {"item_id": "off", "tracking_status": "ended"},
    )
    assert ids(ingest.active_targets(items, TODAY, limit=3)) == ["grace", "today", "open"]
    assert ids(ingest.active_targets(items, TODAY, limit=1)) == ["grace"]
    assert sorted(ids(ingest.active_targets(items, TODAY))) == ["grace", "open", "today"]


def test_comment_targets(spark):
    items = items_table(
        spark,
        {"item_id": "a", "tracking_end_date": "2024-01-31"}, {"item_id": "b", "tracking_end_date": "2024-02-01"},
        {"item_id": "c", "comments_disabled": True}, {"item_id": "d", "comments_at_discovery_captured_at": NOW, "tracking_end_date": TODAY},
        {"item_id": "e", "comments_pre_release_captured_at": NOW, "tracking_end_date": TODAY},
    )
    assert sorted(ids(ingest.comment_targets(items, "at_discovery", TODAY))) == ["a", "b", "e"]
    assert sorted(ids(ingest.comment_targets(items, "pre_release", TODAY))) == ["a", "d"]
    with pytest.raises(ValueError):
        ingest.comment_targets(items, "weekly", TODAY)


def test_transcript_targets_newest_first(spark):
    items = items_table(
        spark, {"item_id": "a", "first_seen_at": "2024-01-05 00:00:00"}, {"item_id": "b"},
        {"item_id": "a", "first_seen_at": "2024-01-01 00:00:00"}, {"item_id": "c", "transcript_captured_at": NOW},
    )
    assert ids(ingest.transcript_targets(items)) == ["a", "b"]


def test_items_end_thirty_days_after_their_date(spark):
    items = items_table(
        spark, {"item_id": "a", "tracking_end_date": "2023-12-31"}, {"item_id": "b", "tracking_end_date": "2023-12-30"},
        {"item_id": "c"}, {"item_id": "d", "tracking_end_date": "2020-01-01", "tracking_status": "unavailable"},
    )
    got = {r.item_id: r.tracking_status for r in ingest.mark_ended(items, TODAY).collect()}
    assert got == {"a": "active", "b": "ended", "c": "active", "d": "unavailable"}


def test_counters_of_repeated_and_broken_documents(spark):
    items = items_table(spark, {"item_id": "a"}, {"item_id": "b"}, {"item_id": "c"})
    stats = spark.createDataFrame([], TABLES["counter_snapshots"].ddl)
    documents = docs(
        spark, doc("a", statistics={"viewCount": "3"}), doc("a", statistics={"viewCount": "5"}), ("b", "{broken"), ("b", None),
        doc("other", statistics={"viewCount": "1"}),
    )
    other = docs(spark, ("b", doc("zz", statistics={"viewCount": "9"})[1]), ("a", doc("a")[1] + " junk"))
    run = ingest.counter_run(items, stats, documents.unionByName(other), TODAY, now())
    got = sorted((r.item_id, r.reason) for r in run.rejects.collect())
    assert got == [("a", "unreadable"), ("b", "other_id"), ("b", "unreadable"), ("b", "unreadable")]
    assert violations(run.rejects, "rejects").count() == 0
    assert [(r.item_id, r.view_count) for r in run.counters.collect()] == [("a", 5)]
    for _ in range(2):
        run = ingest.counter_run(items, stats, documents, TODAY, now())
        stats, items = run.snapshots, run.items
        assert [(r.item_id, r.view_count) for r in stats.collect()] == [("a", 5)]
        assert sorted(r.item_id for r in items.collect()) == ["a", "b", "c"]
    assert run.rejects.count() == 2
    # b came back, though unreadable; c did not come back and ends as unavailable in the first run
    assert {r.item_id: r.tracking_status for r in items.collect()} == {"a": "active", "b": "active", "c": "unavailable"}


def test_every_document_of_an_active_item_is_merged(spark):
    ids = [f"i{n:05d}" for n in range(300)]
    items = items_table(spark, *[{"item_id": i} for i in ids])
    run = ingest.counter_run(
        items, spark.createDataFrame([], TABLES["counter_snapshots"].ddl),
        docs(spark, *[doc(i, statistics={"viewCount": "1"}) for i in ids]), TODAY, now(),
    )
    assert run.snapshots.count() == 300
    attempts = spark.createDataFrame(
        [(i, "words", "x", None, None, None, None, None) for i in ids],
        "item_id string, caption_text string, caption_kind string, caption_error string, speech_text string,"
        " speech_language string, speech_kind string, speech_error string",
    )
    merged, _ = ingest.transcript_run(items, spark.createDataFrame([], TABLES["transcripts"].ddl), attempts, now())
    assert merged.count() == 300


def test_counter_run(spark, frame):
    items = items_table(
        spark, {"item_id": "a", "channel_id": "keep", "region_blocked": ["X"]}, {"item_id": "b"},
        {"item_id": "c", "tracking_status": "ended"}, {"item_id": "d", "tracking_end_date": "2023-12-30"},
    )
    stats = frame(TABLES["counter_snapshots"].ddl, ("a", TODAY, 1, 1, 1, 0, NOW), ("a", "2024-01-29", 1, 1, 1, 0, NOW))
    documents = docs(spark, doc("a", statistics={"viewCount": "9"}, contentDetails={"duration": "PT1M"}), doc("c"))
    run = ingest.counter_run(items, stats, documents, TODAY, now())
    got = {r.item_id: r for r in run.items.collect()}
    assert (got["a"].channel_id, got["a"].region_blocked, got["a"].duration_seconds) == ("keep", ["X"], 60)
    assert str(got["a"].last_collected_at) == NOW
    assert {k: r.tracking_status for k, r in got.items()} == {"a": "active", "b": "unavailable", "c": "ended", "d": "ended"}
    assert got["c"].last_collected_at is None
    snaps = {(r.item_id, str(r.collected_date)): r.view_count for r in run.snapshots.collect()}
    assert snaps == {("a", TODAY): 9, ("a", "2024-01-29"): 1}
    again = ingest.counter_run(items, run.snapshots, documents, TODAY, now())
    assert again.snapshots.count() == 2 and ids(run.unavailable) == ["b"]


def test_comment_run_stamps_and_disables(spark):
    items = items_table(
        spark, {"item_id": "ok", "tracking_end_date": TODAY}, {"item_id": "off"}, {"item_id": "bad"},
        {"item_id": "done", "comments_at_discovery_captured_at": "2024-01-01 00:00:00"},
    )
    thread = json.dumps([{"id": "c", "snippet": {"topLevelComment": {"snippet": {"textDisplay": "t"}}}}] * 2)
    threads = spark.createDataFrame(
        [("ok", "at_discovery", "ok", thread), ("ok", "pre_release", "ok", "[]"), ("off", "at_discovery", "disabled", None),
         ("bad", "at_discovery", "failed", None), ("done", "at_discovery", "ok", thread)],
        "item_id string, snapshot_kind string, state string, payload string",
    )
    run = ingest.comment_run(items, spark.createDataFrame([], TABLES["comments"].ddl), threads, TODAY, now())
    got = {r.item_id: r for r in run.items.collect()}
    assert str(got["ok"].comments_at_discovery_captured_at) == NOW == str(got["ok"].comments_pre_release_captured_at)
    assert got["off"].comments_disabled and str(got["off"].last_collected_at) == NOW
    assert got["bad"].comments_at_discovery_captured_at is None and not got["bad"].comments_disabled
    assert str(got["done"].comments_at_discovery_captured_at) == "2024-01-01 00:00:00"
    # a repeated comment id keeps its last position
    assert [(r.item_id, r.rank) for r in run.comments.collect()] == [("ok", 2)]


def test_transcripts(spark):
    attempts = spark.createDataFrame(
        [("a", "hello world hello", "manual", None, None, None, None, None),
         ("b", "", None, "NoTranscript: long", "spoken words", "fr", "speech", None),
         ("c", None, None, "IpBlocked: long", None, None, None, None)],
        "item_id string, caption_text string, caption_kind string, caption_error string, speech_text string,"
        " speech_language string, speech_kind string, speech_error string",
    )
    got = {r.item_id: r for r in ingest.transcript_rows(attempts, now()).collect()}
    assert (got["a"].source, got["a"].track_kind, got["a"].language, got["a"].word_count, got["a"].char_count) == ("yta", "manual", "en", 3, 17)
    assert (got["b"].source, got["b"].language, got["b"].track_kind, got["b"].error) == ("whisper", "fr", "speech", None)
    assert (got["c"].source, got["c"].word_count, got["c"].char_count) == ("failed", None, None)
    assert got["c"].error == "yta=IpBlocked; whisper=None"
    items = items_table(spark, *[{"item_id": i} for i in "abd"])
    merged, stamped = ingest.transcript_run(items, spark.createDataFrame([], TABLES["transcripts"].ddl), attempts, now())
    assert sorted(ids(merged)) == ["a", "b"]
    assert {r.item_id for r in stamped.filter("transcript_captured_at is not null").collect()} == {"a", "b"}


def test_contract_violations(spark):
    items = items_table(
        spark, {"item_id": "good"}, {"item_id": "kind", "content_kind": "song"}, {"item_id": None},
        {"item_id": "both", "tv_id": 4, "season_number": 1}, {"item_id": "state", "tracking_status": "lost"},
        {"item_id": "tv", "content_kind": "tv", "movie_id": None, "tv_id": 1, "season_number": 1},
    )
    assert {r.item_id for r in violations(items, "items").collect()} == {None, "kind", "both", "state"}
