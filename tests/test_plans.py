import math

import pytest
from pyspark.sql import functions as F

from crestline.plans import findings, metrics, predictions, reads, scores, series, trends

AS_OF = "2024-01-30"
ITEMS = (
    "item_id string, content_kind string, movie_id bigint, name string, video_type string,"
    " published_at timestamp, tracking_status string"
)
STATS = "item_id string, collected_date date, view_count bigint, like_count bigint, comment_count bigint"


def item(i, movie=1, at="2024-01-01 00:00:00", status="active", kind="movie"):
    return (i, kind, movie, f"name {i}", "Trailer", at, status)


def curve(item_id, views, likes=None, start=1):
    """Cumulative snapshots, one per January day from ``start``; None leaves the day out."""
    out = []
    for n, v in enumerate(views):
        if v is not None:
            like = likes[n] if likes else v // 10
            out.append((item_id, f"2024-01-{start + n:02d}", v, like, 0))
    return out


def running(deltas, base=1000):
    out, total = [base], base
    for d in deltas:
        total += d
        out.append(total)
    return out


def one(df):
    got = df.collect()
    assert len(got) == 1
    return got[0]


# --- daily metrics ------------------------------------------------------------------


def test_deltas_lump_gaps_and_start_null(frame):
    stats = frame(STATS, *curve("a", [10, 15, None, None, 40], [1, None, None, None, 6]))
    out = metrics.daily_metrics(stats, frame(ITEMS, item("a")), AS_OF).orderBy("collected_date").collect()
    assert [r.delta_views for r in out] == [None, 5, 25]
    assert [r.delta_likes for r in out] == [None, None, None]
    assert [r.days_since_publish for r in out] == [0, 1, 4]
    assert out[1].like_view_ratio is None


def test_seed_rows_give_the_same_deltas(frame, rows):
    stats = frame(STATS, *curve("a", [10, None, 30, 35, None, 50]), *curve("b", [5] + [None] * 20 + [9]),
                  *curve("c", [7]), ("d", "2020-01-01", 1, 1, 1), ("d", "2024-01-29", 9, 9, 9))
    items = frame(ITEMS, item("a"))
    whole = metrics.daily_metrics(stats, items, AS_OF).filter("collected_date >= date'2024-01-04'")
    assert rows(metrics.daily_metrics(stats, items, AS_OF, since=26)) == rows(whole)
    # a snapshot before the floor does not exist for the view
    assert [r.delta_views for r in whole.filter("item_id = 'd'").collect()] == [None]


def test_zero_views_and_unknown_item(frame):
    out = metrics.daily_metrics(frame(STATS, ("x", "2024-01-02", 0, 0, 0)), frame(ITEMS, item("a")), AS_OF)
    r = one(out)
    assert r.like_view_ratio is None and r.days_since_publish is None


# --- reads --------------------------------------------------------------------------


def test_growth_drops_items_without_known_growth(frame, rows):
    stats = frame(STATS, *curve("new", [100], start=29), *curve("old", [10, 20, 50], start=27))
    assert rows(reads.growth(stats, AS_OF, 7), "item_id", "views_gained") == [("old", 40)]


def test_titles_resolve_by_kind_and_null_links_survive(spark, frame):
    items = spark.sql(
        "select * from values ('a','movie',1L,null,null),('b','tv',null,5L,1L),('c','tv',null,5L,9L),"
        "('d','tv',null,6L,1L) t(item_id, content_kind, movie_id, tv_id, season_number)"
    ).selectExpr(
        "*", "'n' name", "'Trailer' video_type", "'active' tracking_status", "timestamp'2024-01-01' published_at",
        "cast(null as date) tracking_end_date", "cast(null as string) thumbnail_url",
    )
    movies = spark.sql("select 1L movie_id, 'M' title, date'2024-05-01' release_date, '/m' poster_path, array('US') origin_countries")
    shows = spark.sql("select 5L tv_id, 'S' name, '/s' poster_path, array('KR') origin_countries")
    seasons = spark.sql("select 5L tv_id, 1L season_number, date'2024-06-01' air_date")
    titled = reads.titled_items(items, movies, shows, seasons)
    got = {r.item_id: (r.title, str(r.release_date), r.origin_countries) for r in titled.collect()}
    assert got == {
        "a": ("M", "2024-05-01", ["US"]), "b": ("S", "2024-06-01", ["KR"]),
        "c": ("S", "None", ["KR"]), "d": (None, "None", None),
    }
    assert [r.item_id for r in reads.search_items(titled, country="KR").collect()] == ["b", "c"]
    assert reads.search_items(titled, query_text="m", limit=500).count() == 1
    assert reads.search_items(titled, content_kind="tv", tracking_status="ended").count() == 0


def test_top_comments_come_from_the_latest_snapshot(frame):
    ddl = "item_id string, snapshot_kind string, snapshot_date date, rank bigint, comment_id string, text string"
    c = frame(
        ddl, ("a", "at_discovery", "2024-01-01", 1, "x", "t"), ("a", "pre_release", "2024-01-09", 2, "y", "t"),
        ("a", "pre_release", "2024-01-09", 1, "z", "t"), ("b", "at_discovery", "2024-01-01", 1, "w", "t"),
        ("c", "at_discovery", "2019-01-01", 1, "v", "t"),
    )
    got = {(r.item_id, r.comment_id): r.position for r in reads.top_comments(c, AS_OF).collect()}
    assert got == {("a", "z"): 1, ("a", "y"): 2, ("b", "w"): 1}
    assert [r.comment_id for r in reads.top_comments(c, AS_OF, "a", "at_discovery").collect()] == ["x"]
    assert [r.comment_id for r in reads.top_comments(c, AS_OF, limit=1).filter("item_id = 'a'").collect()] == ["z"]


def test_country_fallback_and_coverage(spark):
    items = spark.sql(
        "select * from values (1L, null, 'active'), (1L, null, 'ended'), (2L, null, 'active'), (null, 7L, 'active'),"
        " (2L, 7L, 'unavailable') t(movie_id, tv_id, tracking_status)"
    ).selectExpr("*", "cast(null as timestamp) transcript_captured_at",
                 "timestamp'2024-01-01' comments_at_discovery_captured_at",
                 "cast(null as timestamp) comments_pre_release_captured_at")
    movies = spark.sql("select 1L movie_id, array('US','GB') origin_countries union all select 2L, cast(array() as array<string>)")
    shows = spark.sql("select 7L tv_id, array('KR') origin_countries")
    stats = reads.country_stats(items, movies, shows)
    got = {r.country: (r.total_items, r.active_items) for r in stats.collect()}
    # an empty movie list stays empty even when the show has countries
    assert got == {"US": (2, 1), "GB": (2, 1), "UNKNOWN": (2, 1), "KR": (1, 1)}
    cov = one(reads.coverage(stats, items))
    assert (cov.unique_items, cov.countries_covered, cov.total_attributions, cov.with_comments) == (5, 3, 7, 7)
    assert [r.country for r in reads.top_countries(stats, 2).collect()] == ["GB", "US"]


# --- trends -------------------------------------------------------------------------


def trend(frame, deltas, likes=None, items=None, days=30):
    stats = frame(STATS, *curve("a", running(deltas), likes))
    return one(trends.engagement_trend(stats, frame(ITEMS, *(items or [item("a")])), AS_OF, days))


def test_half_life_of_an_exact_halving_curve(frame):
    r = trend(frame, [10, 1024, 512, 256, 128, 64])
    assert r.post_peak_half_life_days == pytest.approx(1.0)
    assert r.peak_velocity == 1024 and r.data_points == 7


def test_half_life_needs_four_falling_points(frame):
    assert trend(frame, [10, 20, 1024, 512, 256, 128]).post_peak_half_life_days is None  # three
    assert trend(frame, [100, 1, 2, 4, 8, 16]).post_peak_half_life_days is None  # rising
    assert trend(frame, [1024, 0, 512, 256, 0, 128]).post_peak_half_life_days is None  # zeros do not count


def test_demand_states(frame):
    flat = [100] * 8
    assert trend(frame, flat).demand_state == "holding"
    assert trend(frame, [1000] + [300] * 9).demand_state == "cooling"
    assert trend(frame, [1000] + [100] * 9).demand_state == "spent"
    assert trend(frame, [50] * 7 + [100] * 7).demand_state == "rebounding"
    assert trend(frame, [0] * 8).demand_state == "unknown"
    assert trend(frame, [5, 5, 5]).demand_state == "insufficient_data"


def test_quality_bands_are_strict(frame):
    def quality(last):
        likes = [1000 + round((last - 1000) * n / 5) for n in range(6)]
        stats = frame(STATS, *[("a", f"2024-01-{n + 1:02d}", 10_000, likes[n], 0) for n in range(6)])
        r = one(trends.engagement_trend(stats, frame(ITEMS, item("a")), AS_OF))
        return r.quality_classification, r.pct_change_over_window

    assert quality(1100) == ("gaining", pytest.approx(0.1))
    assert quality(900) == ("losing", pytest.approx(-0.1))
    assert quality(1040)[0] == "steady"


def test_movie_without_history_and_launch_window(frame):
    items = frame(ITEMS, item("a", at="2024-01-30 10:00:00"), item("b", at="2023-12-31 10:00:00"),
                  item("c", at="2023-12-30 10:00:00"), item("d", at=None))
    r = one(trends.engagement_trend(frame(STATS), items, AS_OF))
    assert (r.n_items, r.new_items_in_window, r.data_points) == (4, 2, 0)
    assert (r.verdict, r.demand_state) == ("insufficient_data", "insufficient_data")


def test_decay_needs_ten_days_and_counts_every_item_of_the_movie(frame):
    long = [("a", f"2024-01-{n + 1:02d}", 10_000, 1000 - 20 * n, 0) for n in range(10)]
    short = [("b", f"2024-01-{n + 1:02d}", 10_000, 1000, 0) for n in range(9)]
    items = frame(ITEMS, item("a", 1), item("x", 1, at=None), item("b", 2))
    got = {r.bucket: r for r in trends.engagement_decay(frame(STATS, *long, *short), items, AS_OF).collect()}
    assert got["all"].units == 1 and got["2-3"].losing == 1 and got["1"].units == 0
    assert got["all"].median_pct_change == pytest.approx(-0.18)
    assert got["all"].view_weighted_pct_change == pytest.approx(-0.18)
    per_item = trends.decay_units(frame(STATS, *long, *short), items, AS_OF, unit="item").collect()
    assert [(r.unit_id, r.n_items) for r in per_item] == [("a", 2)]
    with pytest.raises(ValueError):
        trends.decay_units(frame(STATS), items, AS_OF, unit="show")


# --- scores -------------------------------------------------------------------------

SCORES = "item_id string, model_version string, scored_date date, excitement double"


def test_sequence_orders_by_time_then_id_and_skips_null_scores(frame, rows):
    items = frame(ITEMS, item("a", at="2024-01-02 00:00:00"), item("b", at="2024-01-01 00:00:00"),
                  item("c", at="2024-01-02 00:00:00"), item("d", at="2024-01-03 00:00:00"))
    s = frame(SCORES, *[(i, "m", "2024-01-20", None if i == "d" else 50.0) for i in "abcd"],
              ("a", "old", "2020-01-01", 1.0))
    got = rows(metrics.score_sequence(s, items, AS_OF), "item_id", "item_ordinal", "n_items")
    assert got == [("a", 2, 3), ("b", 1, 3), ("c", 3, 3)]


def test_latest_version_breaks_ties_by_name(frame):
    s = frame(SCORES, ("a", "m1", "2024-01-20", 1.0), ("a", "m2", "2024-01-20", 1.0), ("a", "m3", "2024-01-01", 1.0))
    assert one(metrics.latest_version(s, AS_OF)).model_version == "m2"
    assert metrics.latest_version(frame(SCORES), AS_OF).count() == 0


def sequence(frame, *scored):
    ddl = "movie_id bigint, item_id string, excitement double, model_version string, item_ordinal bigint, n_items bigint, published_at timestamp"
    return frame(ddl, *[(m, f"{m}-{o}", e, "m", o, n, f"2024-01-0{o} 00:00:00") for m, o, e, n in scored])


def test_score_trend_uses_rounded_scores(frame):
    seq = sequence(frame, (1, 1, 50.004, 2), (1, 2, 48.0, 2), (2, 1, 10.0, 1), (3, 1, 1.0, 2), (3, 2, 9.0, 2))
    got = {r.movie_id: r for r in scores.score_trend(seq).collect()}
    assert got[1].first_last_delta == -2.0 and got[1].verdict == scores.STEADY  # exactly two points
    assert got[2].verdict is None and got[2].first_last_delta is None
    assert got[3].verdict == scores.WARMING and got[3].slope_per_item == 8.0


def test_score_decay_buckets(frame):
    seq = sequence(frame, (1, 1, 50.0, 2), (1, 2, 40.0, 2), (2, 1, 50.0, 3), (2, 2, 0.0, 3), (2, 3, 50.0, 3), (3, 1, 9.0, 1))
    got = {r.bucket: r for r in scores.score_decay(seq).collect()}
    assert (got["all"].movies, got["all"].declining, got["all"].steady) == (2, 1, 1)
    assert got["2"].median_first_last_delta == -10.0 and got["5+"].movies == 0


# --- findings -----------------------------------------------------------------------


def scan_row(frame, vs_peak=0.1, peak=1000, d2r=10, age=20, lv_recent=None, lv_older=None, title="T"):
    ddl = ("movie_id bigint, cur_vel double, peak_vel bigint, lv_recent double, lv_older double, n_items bigint,"
           " active_items bigint, last_item_age_days int, title string, days_to_release int, vs_peak double, _scale double")
    return frame(ddl, (1, vs_peak * peak, peak, lv_recent, lv_older, 2, 1, age, title, d2r, vs_peak, math.log10(peak)))


@pytest.mark.parametrize(
    "change, found",
    [({}, 1), ({"vs_peak": 0.25}, 0), ({"d2r": 0}, 0), ({"d2r": 1}, 1), ({"d2r": 45}, 1), ({"d2r": 46}, 0),
     ({"d2r": None}, 0), ({"age": 10}, 1), ({"age": 9}, 0), ({"age": None}, 0)],
)
def test_trailer_due_limits(frame, change, found):
    assert findings.trailer_due(scan_row(frame, **change)).count() == found


@pytest.mark.parametrize(
    "change, found", [({}, 1), ({"vs_peak": 0.79}, 0), ({"age": 11}, 0), ({"age": None}, 0)]
)
def test_surging_limits(frame, change, found):
    assert findings.surging(scan_row(frame, **{"vs_peak": 0.8, "age": 10, **change})).count() == found


def test_quality_slide_limits_and_text(frame):
    hit = one(findings.quality_slide(scan_row(frame, lv_recent=0.03, lv_older=0.04)))
    assert hit.headline == "T cooling — like/view down 25% this week"
    assert hit.salience == pytest.approx(3 * 0.25) and hit.like_view_older == 0.04
    assert findings.quality_slide(scan_row(frame, lv_recent=0.9, lv_older=1.0)).count() == 0
    assert findings.quality_slide(scan_row(frame, lv_recent=0.0, lv_older=0.1)).count() == 0


def test_salience_of_trailer_due(frame):
    r = one(findings.trailer_due(scan_row(frame, title=None)))
    assert r.salience == pytest.approx(3 * 0.9 * (1 - 10 / 46))
    assert r.title == "movie 1" and r.headline.startswith("None opens in 10d; trailer demand spent (10% of peak)")


def test_fatigue_starts_at_five_points(frame):
    facts = frame("movie_id bigint, top_item_delta bigint", (1, 1000))
    movies = frame("movie_id bigint, title string", (1, "A"), (2, "B"))
    seq = sequence(frame, (1, 1, 60.0, 2), (1, 2, 55.0, 2), (2, 1, 60.0, 2), (2, 2, 55.1, 2))
    r = one(findings.excitement_fatigue(seq, facts, movies))
    assert r.movie_id == 1 and r.salience == pytest.approx(3 * 0.25) and r.excitement_delta == -5.0
    assert r.headline == "A — comment excitement cooling 60→55 across 2 trailers"


def test_tie_keeps_the_earlier_detector(frame):
    c = frame("movie_id bigint, kind string, _priority int, salience double",
              (1, "surging", 1, 2.0), (1, "trailer_due", 0, 2.0), (1, "quality_slide", 2, 1.9))
    assert one(findings.best_per_movie(c)).kind == "trailer_due"


# --- predictions --------------------------------------------------------------------

LOG = (
    "prediction_id string, kind string, movie_id bigint, title string, predicted_at date, horizon_days bigint,"
    " days_to_release_at_prediction bigint, vs_peak_at_prediction double, basis string, status string,"
    " resolved_at date, resolved_item_id string, resolved_lag_days bigint, created_at timestamp, updated_at timestamp"
)


def call(movie, at, status="open", horizon=21, lag=None):
    return (f"{movie}-{at}", "trailer_due", movie, "T", at, horizon, 5, 0.1, "b", status, None, None, lag, None, None)


def outcome(frame, items, at="2024-01-05", today=AS_OF, horizon=21):
    r = one(predictions.resolutions(frame(LOG, call(1, at, horizon=horizon)), frame(ITEMS, *items), today))
    return r.status, r.resolved_item_id, r.resolved_lag_days


def test_hit_on_the_last_day_of_the_horizon(frame):
    assert outcome(frame, [item("a", at="2024-01-26 23:00:00")]) == ("hit", "a", 21)


def test_one_day_late_is_a_miss_once_the_horizon_passed(frame):
    late = [item("a", at="2024-01-27 00:00:00")]
    assert outcome(frame, late) == ("miss", None, None)
    assert outcome(frame, late, today="2024-01-26") == ("open", None, None)


def test_same_day_item_does_not_count(frame):
    assert outcome(frame, [item("a", at="2024-01-05 23:00:00")])[0] == "miss"


def test_earliest_of_two_later_items_confirms(frame):
    two = [item("b", at="2024-01-09 10:00:00"), item("a", at="2024-01-09 12:00:00"), item("c", at="2024-01-07 00:00:00", movie=2)]
    assert outcome(frame, two) == ("hit", "b", 4)


def test_horizon_must_be_exceeded(frame):
    assert outcome(frame, [], at="2024-01-09", today="2024-01-30")[0] == "open"
    assert outcome(frame, [], at="2024-01-08", today="2024-01-30")[0] == "miss"


def test_recording_skips_open_movies_and_repeats(frame, rows):
    log = frame(LOG, call(1, "2024-01-20"), call(2, "2024-01-01", "hit", lag=3))
    found = frame("kind string, movie_id bigint, title string, days_to_release int, vs_peak double, headline string",
                  ("trailer_due", 1, "A", 4, 0.1, "h"), ("trailer_due", 2, "B", 4, 0.1, "h"), ("surging", 3, "C", 4, 0.9, "h"))
    now = F.lit("2024-01-30 06:00:00").cast("timestamp")
    once = predictions.record_predictions(log, found, AS_OF, now)
    assert [r[0] for r in rows(once, "prediction_id")] == ["1-2024-01-20", "2-2024-01-01", "2-2024-01-30"]
    assert rows(predictions.record_predictions(once, found, AS_OF, now)) == rows(once)


def test_every_open_prediction_gets_exactly_one_outcome(frame):
    log = frame(LOG, *[call(m, f"2024-01-{d:02d}") for m in (1, 2, 3) for d in (1, 8, 20)])
    items = frame(ITEMS, item("a", 1, "2024-01-10 00:00:00"), item("b", 2, "2024-01-02 00:00:00"))
    got = predictions.resolutions(log, items, AS_OF).collect()
    assert len(got) == 9 and len({r.prediction_id for r in got}) == 9
    after = predictions.resolve_predictions(log, items, AS_OF, F.current_timestamp())
    assert after.count() == 9


def test_track_record(frame):
    log = frame(LOG, call(1, "2024-01-01", "hit", lag=4), call(2, "2024-01-01", "hit", lag=6),
                call(3, "2024-01-01", "miss"), call(4, "2024-01-01"))
    r = one(predictions.track_record(log))
    assert (r.hits, r.misses, r.open, r.avg_hit_lag_days) == (2, 1, 1, 5.0)
    assert r.hit_rate == pytest.approx(2 / 3)
    assert one(predictions.track_record(log.filter("status = 'open'"))).hit_rate is None


# --- view curves --------------------------------------------------------------------

CANDIDATES = "movie_id bigint, n_items bigint, first_pub date, peak_views bigint, days bigint, title string"


def pair(frame, *cands):
    df = frame(CANDIDATES, *[(m, n, "2024-01-01", peak, days, "T") for m, n, peak, days in cands])
    return {r.role: r.movie_id for r in series.pick_pair(df).collect()}


def test_pairing(frame):
    assert pair(frame, (1, 3, 500_000, 40), (2, 1, 120_000, 30)) == {"many": 1, "few": 2}
    # a long-running many-item movie beats a more famous one below the bar
    assert pair(frame, (1, 8, 100, 40), (2, 9, 900, 39), (3, 4, 50, 44)) == {"many": 1, "few": 3}
    # the narrowest tolerance wins over fame
    assert pair(frame, (1, 8, 900, 40), (2, 2, 800, 50), (3, 2, 100, 44)) == {"many": 1, "few": 3}
    # outside every tolerance fame decides
    assert pair(frame, (1, 8, 900, 90), (2, 2, 800, 20), (3, 2, 100, 25)) == {"many": 1, "few": 2}
    assert pair(frame, (1, 8, 900, 40)) == {}
    assert pair(frame, (1, 2, 900, 40), (2, 1, 800, 40)) == {}


def test_launches_snap_forward_and_merge(frame):
    s = frame("movie_id bigint, collected_date date, day int",
              (1, "2024-01-03", 0), (1, "2024-01-05", 2), (1, "2024-01-09", 6))
    items = frame(ITEMS, item("a", at="2024-01-02 00:00:00"), item("b", at="2024-01-04 00:00:00"),
                  item("c", at="2024-01-05 12:00:00"), item("d", at="2024-01-10 00:00:00"), item("e", at="2024-01-03 00:00:00"))
    assert sorted(r.day for r in series.launch_days(s, items).collect()) == [0, 2]
