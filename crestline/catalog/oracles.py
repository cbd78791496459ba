"""The same results in plain SQL (DuckDB dialect), written independently of the plans."""

from __future__ import annotations

AS_OF = "DATE '2024-01-30'"
NOW = "'2024-01-30 06:00:00'"
_MOVIE = (
    "CAST(floor({c} / 20) AS BIGINT) * 5 + CASE WHEN {c} % 20 < 1 THEN 0 WHEN {c} % 20 < 3 THEN 1"
    " WHEN {c} % 20 < 6 THEN 2 WHEN {c} % 20 < 10 THEN 3 ELSE 4 END"
)
_P = "p_partkey"


def _day(base: str, n: str) -> str:
    return f"(DATE '{base}' + CAST({n} AS INTEGER))"


def _ts(d: str, secs: str = "0") -> str:
    return f"(CAST({d} AS TIMESTAMP) + to_seconds({secs}))"


def txt(ts: str) -> str:
    return f"strftime({ts}, '%Y-%m-%d %H:%M:%S')"


def r6(x: str) -> str:
    return f"round(CAST({x} AS DOUBLE), 6)"


def join_list(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL WHEN len({x}) = 0 THEN '' ELSE array_to_string({x}, '|') END"


BASE = f"""WITH items AS (
  SELECT 'v' || c_custkey AS item_id, c_custkey AS c, c_name AS name,
    CASE WHEN c_custkey % 7 = 6 THEN 'tv' ELSE 'movie' END AS content_kind,
    CASE WHEN c_custkey % 7 <> 6 THEN {_MOVIE.format(c='c_custkey')} END AS movie_id,
    CASE WHEN c_custkey % 7 = 6 THEN c_custkey % 150 END AS tv_id,
    CASE WHEN c_custkey % 7 = 6 THEN c_custkey % 3 + 1 END AS season_number,
    CASE c_custkey % 3 WHEN 0 THEN 'Teaser' WHEN 1 THEN 'Trailer' ELSE 'Official Trailer' END AS video_type,
    CASE WHEN c_custkey % 23 <> 0 THEN
      {_ts(_day('2023-12-16', 'c_custkey * 11 % 45'), 'c_custkey * 37 % 86400')} END AS published_at,
    c_mktsegment AS channel_title, c_custkey % 2 = 0 AS official,
    CASE WHEN c_custkey % 13 <> 0 THEN {_day('2023-12-20', 'c_custkey * 7 % 60')} END AS tracking_end_date,
    20 + c_custkey % 150 AS duration_seconds,
    CASE WHEN c_custkey % 5 = 0 THEN 'KP' ELSE '' END AS region_blocked,
    {_ts(_day('2023-12-20', 'c_custkey % 30'), 'c_custkey * 41 % 86400')} AS first_seen_at,
    CASE WHEN c_custkey % 10 < 7 THEN 'active' WHEN c_custkey % 10 < 9 THEN 'ended' ELSE 'unavailable' END
      AS tracking_status,
    c_custkey % 17 = 0 AS comments_disabled,
    CASE WHEN c_custkey % 3 <> 0 THEN {_ts(_day('2024-01-01', 'c_custkey % 20'))} END AS disc_at,
    CASE WHEN c_custkey % 2 = 0 THEN {_ts(_day('2024-01-05', 'c_custkey % 20'))} END AS pre_at,
    CASE WHEN c_custkey % 4 <> 0 THEN {_ts(_day('2024-01-03', 'c_custkey % 20'))} END AS transcript_at
  FROM customer),
links AS (SELECT * FROM items WHERE content_kind = 'movie' AND movie_id IS NOT NULL),
movies AS (
  SELECT {_P} AS movie_id, p_name || ' ' || {_P} AS title,
    ['en', 'hi', 'ta', 'fr', 'en', 'ko'][{_P} % 6 + 1] AS original_language,
    {_day('2024-01-31', f'{_P} * 7 % 60 - 10')} AS release_date,
    CASE WHEN p_size % 5 <> 0 THEN '/p' || {_P} || '.jpg' END AS poster_path,
    CASE {_P} % 6 WHEN 0 THEN CAST([] AS VARCHAR[]) WHEN 1 THEN ['US'] WHEN 2 THEN ['US', 'GB']
      WHEN 3 THEN ['IN'] ELSE ['C' || ({_P} % 9)] END AS countries
  FROM part),
shows AS (
  SELECT s_suppkey AS tv_id, s_name AS name,
    CASE WHEN s_suppkey % 4 <> 0 THEN '/s' || s_suppkey || '.jpg' END AS poster_path,
    CASE WHEN s_suppkey % 8 = 0 THEN CAST([] AS VARCHAR[]) ELSE [n_name] END AS countries
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
seasons AS (
  SELECT s_suppkey AS tv_id, n AS season_number, {_day('2024-02-01', 's_suppkey % 50 + n')} AS air_date
  FROM supplier, (VALUES (1), (2)) AS x(n)),
counted AS (
  SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n,
    count(*) FILTER (WHERE event_type = 'click') AS clicks,
    count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
    ({_MOVIE.format(c='user_id')}) % 4 AS turn
  FROM events GROUP BY ALL),
increments AS (
  SELECT user_id, d, purchases,
    CASE WHEN turn = 0 THEN n * greatest(1, (30 - day(d)) * 2)
      WHEN turn = 1 THEN CASE WHEN day(d) < 24 THEN 2 ELSE 40 END ELSE n * 10 END AS v,
    CASE WHEN turn = 2 THEN clicks * greatest(1, 30 - day(d) * 2) ELSE clicks * 2 END AS l
  FROM counted),
snaps AS (
  SELECT 'v' || user_id AS item_id, d AS collected_date,
    CAST(sum(v) OVER w AS BIGINT) AS view_count,
    CASE WHEN NOT (user_id % 11 = 3 AND day(d) % 7 = 2) THEN CAST(sum(l) OVER w AS BIGINT) END AS like_count,
    CAST(sum(purchases) OVER w AS BIGINT) AS comment_count
  FROM increments WINDOW w AS (PARTITION BY user_id ORDER BY d)),
deltas AS (
  SELECT *, view_count - lag(view_count) OVER w AS delta_views,
    like_count - lag(like_count) OVER w AS delta_likes,
    comment_count - lag(comment_count) OVER w AS delta_comments
  FROM snaps WINDOW w AS (PARTITION BY item_id ORDER BY collected_date)),
v1 AS (
  SELECT d.*, CASE WHEN view_count <> 0 THEN CAST(like_count AS DOUBLE) / view_count END AS like_view_ratio,
    CASE WHEN view_count <> 0 THEN CAST(comment_count AS DOUBLE) / view_count END AS comment_view_ratio,
    collected_date - CAST(published_at AS DATE) AS days_since_publish
  FROM deltas d LEFT JOIN items USING (item_id)),
mdays AS (
  SELECT movie_id, collected_date AS d, CAST(sum(like_count) AS BIGINT) AS likes,
    CAST(sum(view_count) AS BIGINT) AS views, CAST(sum(delta_views) AS BIGINT) AS dv,
    max(view_count) AS top_views, max(delta_views) AS top_delta
  FROM deltas JOIN links USING (item_id) GROUP BY ALL),
titled AS (
  SELECT i.*, coalesce(m.title, tv.name) AS title, coalesce(m.release_date, se.air_date) AS release_date,
    coalesce(m.poster_path, tv.poster_path) AS poster_path, coalesce(m.countries, tv.countries) AS countries
  FROM items i LEFT JOIN movies m ON i.movie_id = m.movie_id LEFT JOIN shows tv ON i.tv_id = tv.tv_id
  LEFT JOIN seasons se ON i.tv_id = se.tv_id AND i.season_number = se.season_number),
comments AS (
  SELECT 'v' || conv_id AS item_id, conv_id, turn, role, text, turn + 1 AS rank,
    CASE WHEN role = 'assistant' THEN 'pre_release' ELSE 'at_discovery' END AS snapshot_kind,
    CASE WHEN role = 'assistant' AND conv_id % 2 = 0 THEN DATE '2024-01-15' ELSE DATE '2024-01-10' END
      AS snapshot_date,
    conv_id || '-' || turn AS comment_id, CAST(length(text) % 97 AS BIGINT) AS like_count
  FROM conversations),
scores AS (
  SELECT 'v' || vec_id AS item_id, m AS model_version,
    CASE m WHEN 'm1' THEN DATE '2024-01-05' ELSE DATE '2024-01-20' END AS scored_date,
    CASE WHEN vec_id % 19 <> 7 THEN
      greatest(0.0, least(100.0, 50.0 + 100.0 * CAST(embedding[CASE m WHEN 'm1' THEN 1 ELSE 2 END] AS DOUBLE)))
    END AS excitement
  FROM embeddings, (VALUES ('m1'), ('m2')) AS x(m)),
seq AS (
  SELECT l.movie_id, s.item_id, s.excitement, s.model_version, s.scored_date, l.published_at,
    row_number() OVER (PARTITION BY l.movie_id, s.model_version ORDER BY l.published_at NULLS FIRST, s.item_id)
      AS item_ordinal,
    count(*) OVER (PARTITION BY l.movie_id, s.model_version) AS n_items
  FROM scores s JOIN links l USING (item_id) WHERE s.excitement IS NOT NULL),
preds AS (
  SELECT movie_id || '-' || predicted_at AS prediction_id, movie_id, predicted_at, horizon_days, status,
    CASE WHEN status <> 'open' THEN predicted_at + 22 END AS resolved_at,
    CASE WHEN status = 'hit' THEN o_orderkey % 21 END AS resolved_lag_days
  FROM (
    SELECT o_orderkey, {_MOVIE.format(c='o_custkey')} AS movie_id,
      {_day('2023-12-20', 'o_orderkey % 35')} AS predicted_at,
      CAST(CASE WHEN o_orderpriority LIKE '1%' THEN 7 ELSE 21 END AS BIGINT) AS horizon_days,
      CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'hit' ELSE 'miss' END AS status
    FROM orders)
  QUALIFY row_number() OVER (PARTITION BY movie_id, predicted_at ORDER BY o_orderkey) = 1),
resolved AS (
  SELECT p.*, f.item_id AS next_item, f.pub - p.predicted_at AS lag,
    CASE WHEN f.pub - p.predicted_at <= p.horizon_days THEN 'hit'
      WHEN {AS_OF} - p.predicted_at > p.horizon_days THEN 'miss' ELSE 'open' END AS outcome
  FROM (SELECT * FROM preds WHERE status = 'open') p LEFT JOIN LATERAL (
    SELECT item_id, CAST(published_at AS DATE) AS pub FROM links l
    WHERE l.movie_id = p.movie_id AND CAST(published_at AS DATE) > p.predicted_at
    ORDER BY published_at, item_id LIMIT 1) f ON true),
log_after AS (
  SELECT p.prediction_id, p.movie_id, p.predicted_at,
    CASE WHEN p.status = 'open' THEN r.outcome ELSE p.status END AS status,
    CASE WHEN p.status <> 'open' THEN p.resolved_at WHEN r.outcome <> 'open' THEN {AS_OF} END AS resolved_at,
    CASE WHEN r.outcome = 'hit' THEN r.next_item END AS resolved_item_id,
    CASE WHEN p.status <> 'open' THEN p.resolved_lag_days WHEN r.outcome = 'hit' THEN r.lag END
      AS resolved_lag_days,
    CASE WHEN p.status = 'open' AND r.outcome <> 'open' THEN {NOW} END AS updated_at
  FROM preds p LEFT JOIN resolved r USING (prediction_id)),
scan AS (
  SELECT a.*, t.n_items, t.active_items, t.last_item_age_days, m.title,
    m.release_date - {AS_OF} AS days_to_release, cur_vel / peak_vel AS vs_peak,
    log10(greatest(peak_vel, 10)) AS scale
  FROM (
    SELECT movie_id, avg(dv) FILTER (WHERE d > {AS_OF} - 7) AS cur_vel, max(dv) AS peak_vel,
      avg(CASE WHEN views <> 0 THEN CAST(likes AS DOUBLE) / views END) FILTER (WHERE d > {AS_OF} - 7) AS lv_recent,
      avg(CASE WHEN views <> 0 THEN CAST(likes AS DOUBLE) / views END) FILTER (WHERE d <= {AS_OF} - 7) AS lv_older
    FROM mdays GROUP BY movie_id) a
  JOIN (
    SELECT movie_id, count(*) AS n_items, count(*) FILTER (WHERE tracking_status = 'active') AS active_items,
      {AS_OF} - CAST(max(published_at) AS DATE) AS last_item_age_days
    FROM links WHERE published_at IS NOT NULL GROUP BY movie_id) t USING (movie_id)
  JOIN movies m USING (movie_id) WHERE peak_vel > 0),
units_seq AS (
  SELECT movie_id, model_version, count(*) AS n_items, regr_slope(excitement, item_ordinal) AS slope,
    arg_min(excitement, item_ordinal) AS first_score, arg_max(excitement, item_ordinal) AS last_score
  FROM seq GROUP BY movie_id, model_version HAVING count(*) >= 2),
due AS (
  SELECT 'trailer_due' AS kind, 0 AS prio, *, title || ' opens in ' || days_to_release || 'd; trailer demand spent ('
      || CAST(round(vs_peak * 100) AS BIGINT) || '% of peak) — new trailer likely imminent' AS headline,
    scale * (1 - vs_peak) * (1 - days_to_release / 46.0) AS salience
  FROM scan WHERE vs_peak < 0.25 AND days_to_release BETWEEN 1 AND 45 AND last_item_age_days >= 10),
surge AS (
  SELECT 'surging' AS kind, 1 AS prio, *, title || ' trailer surging — still ' || CAST(round(vs_peak * 100) AS BIGINT)
      || '% of peak views ' || last_item_age_days || 'd in' AS headline, scale * vs_peak AS salience
  FROM scan WHERE vs_peak >= 0.8 AND last_item_age_days <= 10),
slide AS (
  SELECT 'quality_slide' AS kind, 2 AS prio, *, title || ' cooling — like/view down '
      || CAST(round((1 - lv_recent / lv_older) * 100) AS BIGINT) || '% this week' AS headline,
    scale * (1 - lv_recent / lv_older) AS salience
  FROM scan WHERE lv_recent <> 0 AND lv_older <> 0 AND lv_recent < lv_older * 0.9),
fatigue AS (
  SELECT u.movie_id, m.title, u.n_items, u.slope, first_score, last_score,
    m.title || ' — comment excitement cooling ' || CAST(round(first_score) AS BIGINT) || '→'
      || CAST(round(last_score) AS BIGINT) || ' across ' || u.n_items || ' trailers' AS headline,
    log10(greatest(coalesce(pk, 0), 10)) * ((first_score - last_score) / 20.0) AS salience
  FROM units_seq u LEFT JOIN (SELECT movie_id, max(top_delta) AS pk FROM mdays GROUP BY movie_id) USING (movie_id)
  JOIN movies m ON m.movie_id = u.movie_id
  WHERE u.model_version = 'm2' AND first_score - last_score >= 5)"""


def q(body: str, ctes: str = "") -> str:
    return BASE + (f", {ctes}" if ctes else "") + " " + body


def _scan_cols(like: bool = False) -> str:
    extra = (
        f"{r6('lv_recent')} AS like_view_recent, {r6('lv_older')} AS like_view_older" if like
        else "CAST(NULL AS DOUBLE) AS like_view_recent, CAST(NULL AS DOUBLE) AS like_view_older"
    )
    return (
        f"kind, movie_id, title, headline, {r6('salience')} AS salience, {r6('vs_peak')} AS vs_peak,"
        f" peak_vel AS peak_daily_views, {r6('cur_vel')} AS current_daily_views, days_to_release,"
        f" last_item_age_days, n_items, active_items, {extra}, CAST(NULL AS DOUBLE) AS first_excitement,"
        " CAST(NULL AS DOUBLE) AS last_excitement, CAST(NULL AS DOUBLE) AS excitement_delta,"
        " CAST(NULL AS DOUBLE) AS slope_per_item"
    )


_FATIGUE_COLS = (
    f"'excitement_fatigue' AS kind, movie_id, title, headline, {r6('salience')} AS salience,"
    " CAST(NULL AS DOUBLE) AS vs_peak, CAST(NULL AS BIGINT) AS peak_daily_views,"
    " CAST(NULL AS DOUBLE) AS current_daily_views, CAST(NULL AS BIGINT) AS days_to_release,"
    " CAST(NULL AS BIGINT) AS last_item_age_days, n_items, CAST(NULL AS BIGINT) AS active_items,"
    " CAST(NULL AS DOUBLE) AS like_view_recent, CAST(NULL AS DOUBLE) AS like_view_older,"
    " round(first_score, 1) AS first_excitement, round(last_score, 1) AS last_excitement,"
    " round(last_score - first_score, 1) AS excitement_delta, round(slope, 3) AS slope_per_item"
)
_ALL_FINDINGS = (
    f"cand AS (SELECT {_scan_cols()}, 0 AS prio, salience AS raw FROM due"
    f" UNION ALL SELECT {_scan_cols()}, 1, salience FROM surge"
    f" UNION ALL SELECT {_scan_cols(True)}, 2, salience FROM slide"
    f" UNION ALL SELECT {_FATIGUE_COLS}, 3, salience FROM fatigue),"
    " best AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY movie_id ORDER BY raw DESC, prio) = 1)"
)
_URL = "CASE WHEN poster_path <> '' THEN 'https://image.tmdb.org/t/p/w500' || poster_path END"


def _trending(days: int, limit: int, keep: str = "true") -> str:
    return f"""growth AS (
  SELECT item_id, CAST(sum(delta_views) AS BIGINT) AS views_gained, CAST(sum(delta_likes) AS BIGINT) AS likes_gained,
    max(view_count) AS view_count, avg(like_view_ratio) AS avg_like_view_ratio
  FROM v1 WHERE collected_date >= {AS_OF} - {days} GROUP BY item_id),
top AS (
  SELECT item_id, content_kind, title, name AS item_name, tracking_status, release_date, countries, poster_path,
    views_gained, likes_gained, g.view_count, avg_like_view_ratio, {_URL} AS poster_url
  FROM growth g JOIN titled USING (item_id) WHERE views_gained IS NOT NULL AND {keep}
  ORDER BY views_gained DESC, item_id LIMIT {limit})"""


def _decay(unit: str) -> str:
    base = (
        "SELECT movie_id AS unit_id, movie_id, d, likes, views FROM mdays" if unit == "movie" else
        "SELECT item_id AS unit_id, movie_id, collected_date AS d, like_count AS likes, view_count AS views"
        " FROM deltas JOIN links USING (item_id)"
    )
    return q(
        f"""SELECT b.bucket, count(pct) AS units, count(*) FILTER (WHERE pct < -0.05) AS losing,
  count(pct) - count(*) FILTER (WHERE pct < -0.05) - count(*) FILTER (WHERE pct > 0.05) AS steady,
  count(*) FILTER (WHERE pct > 0.05) AS gaining,
  CASE WHEN count(pct) > 0 THEN {r6('count(*) FILTER (WHERE pct < -0.05) / count(pct)')} END AS losing_share,
  {r6('median(pct)')} AS median_pct_change,
  CASE WHEN sum(weight) > 0 THEN {r6('sum(pct * weight) / sum(weight)')} END AS view_weighted_pct_change
FROM (VALUES ('all', 0, 1000000000), ('1', 1, 1), ('2-3', 2, 3), ('4+', 4, 1000000000)) AS b(bucket, lo, hi)
LEFT JOIN units u ON u.n_items BETWEEN b.lo AND b.hi GROUP BY b.bucket""",
        f"""base AS ({base}),
fit AS (
  SELECT unit_id, movie_id, regr_slope(lv, x) AS slope, avg(lv) AS mean_lv, avg(x) AS mean_x, min(x) AS x0,
    max(x) AS x1, max(views) AS weight
  FROM (SELECT *, CAST(likes AS DOUBLE) / views AS lv, d - {AS_OF} AS x FROM base WHERE views > 0)
  WHERE lv > 0 GROUP BY unit_id, movie_id HAVING count(*) >= 10 AND var_pop(x) > 0),
units AS (
  SELECT unit_id, n_items, weight, (e - s) / s AS pct FROM (
    SELECT *, mean_lv - slope * mean_x + slope * x0 AS s, mean_lv - slope * mean_x + slope * x1 AS e
    FROM fit JOIN (SELECT movie_id, count(*) AS n_items FROM links GROUP BY movie_id) USING (movie_id))
  WHERE s > 0)""",
    )


_COUNTRY = """country AS (
  SELECT country, count(*) AS total_items, count(*) FILTER (WHERE tracking_status = 'active') AS active_items,
    count(*) FILTER (WHERE tracking_status = 'ended') AS ended_items,
    count(*) FILTER (WHERE tracking_status = 'unavailable') AS unavailable_items,
    count(transcript_at) AS with_transcript,
    count(*) FILTER (WHERE disc_at IS NOT NULL OR pre_at IS NOT NULL) AS with_comments
  FROM (SELECT t.*, unnest(CASE WHEN coalesce(len(countries), 0) = 0 THEN ['UNKNOWN'] ELSE countries END) AS country
    FROM titled t) GROUP BY country)"""

ORACLES: dict[str, str] = {}

_TREND = (
    f"SELECT item_id, content_kind, title, item_name, tracking_status, release_date, {join_list('countries')}"
    f" AS origin_countries, poster_path, views_gained, likes_gained, view_count,"
    f" {r6('avg_like_view_ratio')} AS avg_like_view_ratio, poster_url FROM top"
)
ORACLES["trending"] = q(_TREND, _trending(7, 20))
ORACLES["trending_maintained"] = ORACLES["trending"]
ORACLES["trending_country"] = q(
    _TREND, _trending(14, 20, "content_kind = 'movie' AND list_contains(countries, 'US')")
)
_V1_COLS = (
    "collected_date, view_count, like_count, comment_count, delta_views, delta_likes, delta_comments,"
    f" {r6('like_view_ratio')} AS like_view_ratio, {r6('comment_view_ratio')} AS comment_view_ratio,"
    " days_since_publish"
)
ORACLES["daily_metrics"] = q(f"SELECT item_id, {_V1_COLS} FROM v1")
ORACLES["daily_metrics_recent"] = q(f"SELECT item_id, {_V1_COLS} FROM v1 WHERE collected_date >= {AS_OF} - 7")
ORACLES["item_metrics_one"] = q(
    f"SELECT item_id, {_V1_COLS} FROM v1 WHERE item_id = (SELECT item_id FROM top)", _trending(7, 1)
)
_TITLE_COLS = (
    "item_id, content_kind, movie_id, tv_id, season_number, name AS item_name, video_type, tracking_status,"
    f" {txt('published_at')} AS published_at, tracking_end_date, title, release_date, poster_path,"
    f" {join_list('countries')} AS origin_countries"
)
ORACLES["title_resolution"] = q(f"SELECT {_TITLE_COLS} FROM titled")
ORACLES["search_items"] = q(
    f"SELECT {_TITLE_COLS}, {_URL} AS poster_url FROM titled WHERE content_kind = 'movie'"
    " AND tracking_status = 'active' AND list_contains(countries, 'US') AND lower(title) LIKE '%i_g%'"
    " ORDER BY titled.published_at DESC NULLS LAST, item_id LIMIT 25"
)
ORACLES["top_comments_latest"] = q(
    "SELECT item_id, snapshot_kind, snapshot_date, rank, comment_id, text, like_count,"
    " row_number() OVER (PARTITION BY item_id ORDER BY rank, comment_id) AS position FROM comments"
    " WHERE (item_id, snapshot_date) IN (SELECT item_id, max(snapshot_date) FROM comments GROUP BY item_id)"
    " QUALIFY position <= 30"
)
ORACLES["top_comments_kind"] = q(
    "SELECT item_id, snapshot_date, rank, comment_id, like_count,"
    " row_number() OVER (PARTITION BY item_id ORDER BY rank, comment_id) AS position FROM comments"
    " WHERE snapshot_kind = 'at_discovery' QUALIFY position <= 3"
)
ORACLES["country_stats"] = q("SELECT * FROM country", _COUNTRY)
ORACLES["coverage"] = q(
    "SELECT (SELECT count(*) FROM items) AS unique_items, count(*) FILTER (WHERE country <> 'UNKNOWN')"
    " AS countries_covered, CAST(sum(total_items) AS BIGINT) AS total_attributions,"
    " CAST(sum(active_items) AS BIGINT) AS active_items, CAST(sum(with_comments) AS BIGINT) AS with_comments,"
    " CAST(sum(with_transcript) AS BIGINT) AS with_transcript FROM country",
    _COUNTRY,
)
ORACLES["top_countries"] = q(
    "SELECT country, total_items FROM country WHERE country <> 'UNKNOWN' ORDER BY total_items DESC, country LIMIT 8",
    _COUNTRY,
)
ORACLES["carousel"] = q(
    "SELECT item_id, title, poster_url, views_gained, likes_gained, view_count, release_date, content_kind"
    " FROM top WHERE poster_url IS NOT NULL",
    _trending(30, 10),
)
ORACLES["representative_item"] = q(
    "SELECT item_id, movie_id, count(*) AS n_comments FROM comments JOIN links USING (item_id)"
    " WHERE snapshot_kind = 'at_discovery' GROUP BY ALL ORDER BY n_comments DESC, item_id LIMIT 1"
)
ORACLES["latest_stats_candidates"] = q(
    "SELECT item_id, m.title AS movie_title, original_language, video_type, name AS item_name, channel_title,"
    " duration_seconds, coalesce(s.view_count, 0) AS view_count FROM items JOIN movies m USING (movie_id)"
    " LEFT JOIN (SELECT * FROM snaps QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY collected_date DESC)"
    " = 1) s USING (item_id) WHERE content_kind = 'movie' AND duration_seconds >= 45 AND (original_language IN"
    " ('hi', 'ta', 'te', 'ml', 'kn', 'pa', 'bn', 'mr') OR list_contains(countries, 'IN'))"
    " ORDER BY view_count DESC, item_id LIMIT 10"
)
ORACLES["movie_series"] = q(
    "SELECT movie_id, d AS collected_date, likes, views, dv AS delta_views,"
    f" {r6('CAST(likes AS DOUBLE) / views')} AS like_view_ratio FROM mdays WHERE views > 0"
)
ORACLES["engagement_trend"] = q(
    f"""SELECT movie_id, n_items, new_items_in_window, data_points, demand_state,
  {r6('CASE WHEN pts >= 5 THEN cur END')} AS current_velocity, {r6('CASE WHEN pts >= 5 THEN peak END')} AS peak_velocity,
  {r6('vs_peak')} AS velocity_vs_peak, {r6('CASE WHEN pts >= 5 THEN half END')} AS post_peak_half_life_days,
  quality AS quality_classification, {r6('CASE WHEN fitted THEN slope END')} AS slope_per_day,
  {r6('CASE WHEN fitted THEN change END')} AS pct_change_over_window, {r6('CASE WHEN fitted THEN s0 END')} AS ratio_start,
  {r6('CASE WHEN fitted THEN s1 END')} AS ratio_end, {r6('CASE WHEN fitted THEN mean_ratio END')} AS avg_like_view_ratio,
  CASE WHEN fitted THEN quality || ' quality / ' || demand_state || ' demand' ELSE 'insufficient_data' END AS verdict
FROM (
  SELECT *, CASE WHEN pts < 5 THEN 'insufficient_data' WHEN prior > 0 AND cur > 1.25 * prior THEN 'rebounding'
      WHEN vs_peak IS NULL THEN 'unknown' WHEN vs_peak >= 0.5 THEN 'holding' WHEN vs_peak >= 0.2 THEN 'cooling'
      ELSE 'spent' END AS demand_state,
    CASE WHEN NOT fitted THEN 'insufficient_data' WHEN change > 0.05 THEN 'gaining' WHEN change < -0.05 THEN 'losing'
      ELSE 'steady' END AS quality
  FROM (
    SELECT n.*, coalesce(g.data_points, 0) AS data_points, coalesce(g.pts, 0) AS pts, cur, prior, peak, slope,
      mean_ratio, CASE WHEN tail_n >= 4 AND tail_slope < 0 THEN ln(2.0) / -tail_slope END AS half,
      CASE WHEN coalesce(g.pts, 0) >= 5 AND peak > 0 THEN cur / peak END AS vs_peak,
      coalesce(g.data_points, 0) >= 5 AND slope IS NOT NULL AS fitted,
      b0 + slope * x0 AS s0, b0 + slope * x1 AS s1,
      CASE WHEN b0 + slope * x0 <> 0 THEN (slope * x1 - slope * x0) / (b0 + slope * x0) ELSE 0 END AS change
    FROM n LEFT JOIN g USING (movie_id)))""",
    f"""n AS (
  SELECT movie_id, count(*) AS n_items,
    count(*) FILTER (WHERE {AS_OF} - CAST(published_at AS DATE) <= 30) AS new_items_in_window
  FROM links GROUP BY movie_id),
s AS (
  SELECT movie_id, d, dv, CAST(likes AS DOUBLE) / views AS ratio, d - min(d) OVER (PARTITION BY movie_id) AS x
  FROM mdays WHERE views > 0),
pts AS (
  SELECT movie_id, d, CAST(dv AS DOUBLE) AS dv, row_number() OVER (PARTITION BY movie_id ORDER BY d) - 1 AS i,
    max(d) OVER (PARTITION BY movie_id) - d AS ago, max(dv) OVER (PARTITION BY movie_id) AS peak
  FROM s WHERE dv IS NOT NULL),
pk AS (SELECT movie_id, min(i) AS pi FROM pts WHERE dv = peak GROUP BY movie_id),
dm AS (
  SELECT movie_id, count(*) AS pts, max(peak) AS peak, avg(dv) FILTER (WHERE ago <= 6) AS cur,
    avg(dv) FILTER (WHERE ago BETWEEN 7 AND 13) AS prior, count(*) FILTER (WHERE i > pi AND dv > 0) AS tail_n
  FROM pts JOIN pk USING (movie_id) GROUP BY movie_id),
tail AS (
  SELECT movie_id, regr_slope(ln(dv), i) AS tail_slope FROM pts JOIN pk USING (movie_id)
  WHERE i > pi AND dv > 0 GROUP BY movie_id),
g AS (
  SELECT s.movie_id, count(*) AS data_points, regr_slope(ratio, x) AS slope, regr_intercept(ratio, x) AS b0,
    min(x) FILTER (WHERE ratio IS NOT NULL) AS x0, max(x) FILTER (WHERE ratio IS NOT NULL) AS x1,
    avg(ratio) AS mean_ratio, any_value(dm.pts) AS pts, any_value(dm.peak) AS peak, any_value(dm.cur) AS cur,
    any_value(dm.prior) AS prior, any_value(dm.tail_n) AS tail_n, any_value(tail_slope) AS tail_slope
  FROM s LEFT JOIN dm USING (movie_id) LEFT JOIN tail USING (movie_id) GROUP BY s.movie_id)""",
)
ORACLES["recent_launches"] = q(
    f"SELECT movie_id, item_id, name AS item_name, video_type, {txt('published_at')} AS published_at, tracking_status"
    f" FROM links WHERE {AS_OF} - CAST(links.published_at AS DATE) <= 20"
)
ORACLES["engagement_decay_group"] = _decay("movie")
ORACLES["engagement_decay_item"] = _decay("item")
_CAND = """cand AS (
  SELECT movie_id, p.n_items, first_pub, peak_views, days, title FROM (
    SELECT movie_id, count(*) AS n_items, CAST(min(published_at) AS DATE) AS first_pub FROM links
    WHERE published_at IS NOT NULL GROUP BY movie_id) p
  JOIN (SELECT movie_id, max(top_views) AS peak_views, count(DISTINCT d) AS days FROM mdays GROUP BY movie_id) v
    USING (movie_id)
  JOIN movies USING (movie_id) WHERE days >= 10 AND peak_views >= 20)"""
ORACLES["view_candidates"] = q("SELECT * FROM cand", _CAND)
ORACLES["view_timeseries"] = q(
    """SELECT role, p.movie_id, title, n_items, days AS days_tracked, s.day, s.dv,
  EXISTS (SELECT 1 FROM snap WHERE snap.movie_id = s.movie_id AND snap.day = s.day) AS launch
FROM pair p JOIN series s USING (movie_id) WHERE (SELECT count(*) FROM pair) = 2""",
    _CAND + """,
many AS (SELECT * FROM cand WHERE n_items >= 3
  ORDER BY (n_items >= 8 AND days >= 40) DESC, peak_views DESC, movie_id LIMIT 1),
few AS (SELECT c.* FROM cand c, many m WHERE c.n_items <= 4 AND c.movie_id <> m.movie_id
  ORDER BY CASE WHEN abs(c.days - m.days) <= 4 THEN 0 WHEN abs(c.days - m.days) <= 8 THEN 1
    WHEN abs(c.days - m.days) <= 15 THEN 2 WHEN abs(c.days - m.days) <= 30 THEN 3 ELSE 4 END,
    c.peak_views DESC, c.movie_id LIMIT 1),
pair AS (SELECT 'many' AS role, * FROM many UNION ALL SELECT 'few', * FROM few),
series AS (SELECT movie_id, d, d - min(d) OVER (PARTITION BY movie_id) AS day, dv FROM mdays WHERE dv IS NOT NULL),
snap AS (
  SELECT l.movie_id, min(s.day) AS day FROM links l JOIN series s
    ON l.movie_id = s.movie_id AND s.d >= CAST(l.published_at AS DATE)
  WHERE CAST(l.published_at AS DATE) >= (SELECT min(d) FROM series x WHERE x.movie_id = l.movie_id)
  GROUP BY l.movie_id, CAST(l.published_at AS DATE))""",
)
ORACLES["score_sequence"] = q(
    f"SELECT movie_id, item_id, {r6('excitement')} AS excitement, model_version, scored_date,"
    f" {txt('published_at')} AS published_at, item_ordinal, n_items FROM seq"
)
ORACLES["latest_score_version"] = q(
    "SELECT model_version FROM scores GROUP BY model_version ORDER BY max(scored_date) DESC, model_version DESC LIMIT 1"
)
ORACLES["score_decay"] = q(
    f"""SELECT b.bucket, count(u.movie_id) AS movies, count(*) FILTER (WHERE delta < -2) AS declining,
  count(u.movie_id) - count(*) FILTER (WHERE delta < -2) - count(*) FILTER (WHERE delta > 2) AS steady,
  count(*) FILTER (WHERE delta > 2) AS rising,
  CASE WHEN count(u.movie_id) > 0 THEN {r6('count(*) FILTER (WHERE delta < -2) / count(u.movie_id)')} END
    AS declining_share,
  round(median(delta), 2) AS median_first_last_delta, round(avg(slope), 3) AS mean_slope_per_item
FROM (VALUES ('all', 2, 1000000000), ('2', 2, 2), ('3-4', 3, 4), ('5+', 5, 1000000000)) AS b(bucket, lo, hi)
LEFT JOIN (SELECT *, last_score - first_score AS delta FROM units_seq WHERE model_version = 'm2') u
  ON u.n_items BETWEEN b.lo AND b.hi GROUP BY b.bucket"""
)


def _score_trend(version: str) -> str:
    return f"""st AS (
  SELECT movie_id, model_version, count(*) AS n_items,
    CASE WHEN count(*) >= 2 THEN arg_max(e, item_ordinal) - arg_min(e, item_ordinal) END AS delta,
    CASE WHEN count(*) >= 2 THEN round(regr_slope(e, item_ordinal), 3) END AS slope_per_item
  FROM (SELECT *, round(excitement, 2) AS e FROM seq WHERE model_version = '{version}') GROUP BY ALL)"""


_VERDICT = (
    "CASE WHEN delta < -2 THEN 'cooling — later trailers draw less-excited comments'"
    " WHEN delta > 2 THEN 'warming — later trailers draw more-excited comments'"
    " WHEN delta IS NOT NULL THEN 'steady excitement across trailers' END"
)
ORACLES["score_trend"] = q(
    f"SELECT movie_id, model_version, n_items, round(delta, 2) AS first_last_delta, slope_per_item,"
    f" {_VERDICT} AS verdict FROM st",
    _score_trend("m1"),
)
ORACLES["score_examples"] = q(
    f"SELECT movie_id, m.title, s.n_items, round(delta, 2) AS first_last_delta, slope_per_item, {_VERDICT} AS verdict,"
    f" item_ordinal, round(excitement, 2) AS excitement, {txt('published_at')} AS published_at"
    " FROM seq s JOIN st USING (movie_id, model_version) JOIN movies m USING (movie_id) WHERE movie_id IN"
    " (SELECT movie_id FROM st WHERE n_items >= 2 ORDER BY n_items DESC, movie_id LIMIT 3)",
    _score_trend("m2"),
)
ORACLES["finding_trailer_due"] = q(f"SELECT {_scan_cols()} FROM due")
ORACLES["finding_surging"] = q(f"SELECT {_scan_cols()} FROM surge")
ORACLES["finding_quality_slide"] = q(f"SELECT {_scan_cols(True)} FROM slide")
ORACLES["finding_fatigue"] = q(f"SELECT {_FATIGUE_COLS} FROM fatigue")
ORACLES["findings_all"] = q("SELECT * EXCLUDE (prio, raw) FROM best", _ALL_FINDINGS)
_TOP6 = "(SELECT * FROM best ORDER BY raw DESC, prio, movie_id LIMIT 6)"
ORACLES["findings_top"] = q(f"SELECT * EXCLUDE (prio, raw) FROM {_TOP6}", _ALL_FINDINGS)
ORACLES["finding_series"] = q(
    f"SELECT t.movie_id, t.kind, d AS day, {r6('dv')} AS dv FROM {_TOP6} t JOIN mdays USING (movie_id)"
    " WHERE kind <> 'excitement_fatigue' UNION ALL SELECT t.movie_id, t.kind, CAST(published_at AS DATE),"
    f" {r6('excitement')} FROM {_TOP6} t JOIN seq USING (movie_id) WHERE kind = 'excitement_fatigue'"
    " AND model_version = 'm2'",
    _ALL_FINDINGS,
)
ORACLES["predictions_open"] = q(
    "SELECT prediction_id, movie_id, predicted_at, horizon_days FROM preds WHERE status = 'open'"
)
ORACLES["predictions_recorded"] = q(
    f"SELECT movie_id || '-2024-01-30' AS prediction_id, kind, movie_id, title, {AS_OF} AS predicted_at,"
    " CAST(21 AS BIGINT) AS horizon_days, days_to_release AS days_to_release_at_prediction, vs_peak AS vs_peak_at_prediction,"
    " headline AS basis, 'open' AS status, CAST(NULL AS DATE) AS resolved_at, CAST(NULL AS VARCHAR) AS"
    f" resolved_item_id, CAST(NULL AS BIGINT) AS resolved_lag_days, {NOW} AS created_at, {NOW} AS updated_at"
    " FROM best WHERE kind = 'trailer_due' AND movie_id NOT IN"
    " (SELECT CASE WHEN movie_id % 2 = 1 THEN -movie_id ELSE movie_id END FROM preds WHERE status = 'open')",
    _ALL_FINDINGS,
)
ORACLES["predictions_resolved"] = q(
    f"SELECT prediction_id, movie_id, outcome AS status, CASE WHEN outcome <> 'open' THEN {AS_OF} END AS resolved_at,"
    " CASE WHEN outcome = 'hit' THEN next_item END AS resolved_item_id,"
    " CASE WHEN outcome = 'hit' THEN lag END AS resolved_lag_days FROM resolved"
)
ORACLES["predictions_daily_update"] = q(
    f"SELECT * FROM log_after UNION ALL SELECT movie_id || '-2024-01-30', movie_id, {AS_OF}, 'open', NULL, NULL,"
    f" NULL, {NOW} FROM best WHERE kind = 'trailer_due'"
    " AND movie_id NOT IN (SELECT movie_id FROM log_after WHERE status = 'open')",
    _ALL_FINDINGS,
)
ORACLES["track_record"] = q(
    f"""SELECT count(*) FILTER (WHERE status = 'hit') AS hits, count(*) FILTER (WHERE status = 'miss') AS misses,
  count(*) FILTER (WHERE status = 'open') AS open,
  {r6("count(*) FILTER (WHERE status = 'hit') / count(*) FILTER (WHERE status <> 'open')")} AS hit_rate,
  {r6("avg(resolved_lag_days) FILTER (WHERE status = 'hit')")} AS avg_hit_lag_days FROM log_after"""
)
_LAST_ORDER = (
    "last_order AS (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)"
)
ORACLES["upsert_merge"] = q(
    f"""SELECT coalesce(ck, o_custkey) AS k,
  CASE WHEN c_custkey IS NULL THEN 'order ' || o_orderkey ELSE c_name END AS name,
  {r6('CASE WHEN o_custkey IS NOT NULL THEN o_totalprice ELSE c_acctbal END')} AS amount,
  CASE WHEN c_custkey IS NOT NULL AND o_custkey IS NOT NULL THEN o_orderstatus END AS status
FROM (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END AS ck FROM customer)
FULL JOIN last_order ON ck = o_custkey""",
    _LAST_ORDER,
)
ORACLES["patch_update"] = q(
    f"""SELECT ck AS k, c_name AS name, {r6('c_acctbal + coalesce(o_totalprice, 0)')} AS amount,
  CASE WHEN o_custkey IS NULL THEN NULL WHEN o_orderstatus = 'P' THEN 'kept' ELSE o_orderstatus END AS status
FROM (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN -c_custkey ELSE c_custkey END AS ck FROM customer)
LEFT JOIN last_order ON ck = o_custkey""",
    _LAST_ORDER,
)
ORACLES["bounded_scan"] = q(f"SELECT * FROM snaps WHERE collected_date >= {AS_OF} - 3")
ORACLES["sql_read"] = q(
    "SELECT tracking_status, count(*) AS n, max(duration_seconds) AS longest FROM items"
    " WHERE duration_seconds >= 45 AND content_kind = 'movie' GROUP BY tracking_status"
)
ORACLES["contract_check"] = q(
    "SELECT 'items' AS table_name, count(*) AS violations FROM items WHERE content_kind NOT IN ('movie', 'tv')"
    " OR (movie_id IS NULL) = (tv_id IS NULL) UNION ALL SELECT 'counter_snapshots', count(*) FROM snaps WHERE"
    " item_id IS NULL UNION ALL SELECT 'comments', count(*) FROM comments WHERE comment_id IS NULL UNION ALL"
    " SELECT 'predictions', count(*) FROM preds WHERE status NOT IN ('open', 'hit', 'miss')"
)
ORACLES["mark_missing"] = q(
    "SELECT item_id, CASE WHEN c % 29 = 0 THEN 'unavailable' ELSE tracking_status END AS tracking_status,"
    f" CASE WHEN c % 29 = 0 THEN {NOW} END AS last_collected_at FROM items"
)
ORACLES["mark_ended"] = q(
    "SELECT item_id, CASE WHEN tracking_status = 'active' AND DATE '2024-02-20' > tracking_end_date + 30"
    " THEN 'ended' ELSE tracking_status END AS tracking_status FROM items"
)
_ACTIVE = (
    f"active AS (SELECT * FROM items WHERE tracking_status = 'active' AND (published_at IS NULL OR"
    f" CAST(published_at AS DATE) <= {AS_OF}) AND (tracking_end_date IS NULL OR {AS_OF} <= tracking_end_date + 7))"
)
ORACLES["select_active_soonest"] = q(
    "SELECT item_id, tracking_end_date FROM active ORDER BY tracking_end_date NULLS LAST, item_id LIMIT 20", _ACTIVE
)
ORACLES["select_active"] = q("SELECT item_id, tracking_end_date FROM active", _ACTIVE)
_DISC = "tracking_status = 'active' AND NOT comments_disabled AND disc_at IS NULL"
_PRE = (
    f"tracking_status = 'active' AND NOT comments_disabled AND pre_at IS NULL"
    f" AND tracking_end_date BETWEEN {AS_OF} AND {AS_OF} + 1"
)
ORACLES["select_at_discovery"] = q(f"SELECT item_id FROM items WHERE {_DISC}")
ORACLES["select_pre_release"] = q(f"SELECT item_id FROM items WHERE {_PRE}")
ORACLES["select_untranscribed"] = q(
    f"SELECT item_id, {txt('max(first_seen_at)')} AS first_seen_at FROM items"
    " WHERE transcript_at IS NULL AND tracking_status = 'active' GROUP BY item_id"
)
ORACLES["anti_join_unscored"] = q(
    "SELECT DISTINCT item_id FROM comments WHERE snapshot_kind = 'at_discovery' AND item_id NOT IN"
    " (SELECT item_id FROM scores WHERE CAST(substr(item_id, 2) AS BIGINT) % 3 <> 0 AND model_version = 'm1')"
)

# --- documents: the expected rows straight from the source columns ------------------

_DURATION = (
    "CASE c_custkey % 6 WHEN 0 THEN c_custkey % 3 * 3600 + c_custkey % 60 * 60 + c_custkey % 59"
    " WHEN 1 THEN c_custkey % 60 * 60 WHEN 2 THEN c_custkey % 90 WHEN 3 THEN 0 END"
)
_DURATION_TEXT = (
    "CASE c_custkey % 6 WHEN 0 THEN 'PT' || c_custkey % 3 || 'H' || c_custkey % 60 || 'M' || c_custkey % 59 || 'S'"
    " WHEN 1 THEN 'PT' || c_custkey % 60 || 'M' WHEN 2 THEN 'PT' || c_custkey % 90 || 'S' WHEN 3 THEN 'PT'"
    " WHEN 4 THEN c_custkey % 60 || ':30' ELSE 'P1DT5S' END"
)
_THUMB = (
    "CASE WHEN c_custkey % 8 = 4 THEN 'm' || c_custkey WHEN c_custkey % 3 = 0 THEN 'h' || c_custkey"
    " WHEN c_custkey % 5 <> 0 THEN 'd' || c_custkey END"
)
_BACK = "FROM customer WHERE c_custkey % 29 <> 0"
_LIKES = "CASE WHEN c_custkey % 9 <> 0 THEN c_custkey % 101 END"
_REPLIES = "CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 7 END"
ORACLES["flatten_stats_json"] = (
    f"SELECT 'v' || c_custkey AS item_id, {AS_OF} AS collected_date, c_custkey * 13 AS view_count,"
    f" {_LIKES} AS like_count, {_REPLIES} AS comment_count, CAST(0 AS BIGINT) AS favorite_count,"
    f" {NOW} AS collected_at {_BACK}"
)
ORACLES["flatten_registry_json"] = (
    "SELECT 'v' || c_custkey AS item_id, 'ch' || c_custkey % 40 AS channel_id, CASE WHEN c_custkey % 6 <> 0 THEN"
    f" 'seen' END AS channel_title, {_THUMB} AS thumbnail_url, c_name AS description, {_DURATION} AS duration_seconds,"
    " 'hd' AS definition, c_custkey % 2 = 0 AS embeddable, CASE WHEN c_custkey % 12 = 0 THEN 'RU|KP' ELSE '' END"
    f" AS region_blocked, {NOW} AS last_collected_at {_BACK}"
)
ORACLES["flatten_comments_json"] = f"""WITH s AS (
  SELECT conv_id, turn, role, unnest(string_split(text, '.')) AS s, generate_subscripts(string_split(text, '.'), 1) - 1 AS i
  FROM conversations)
SELECT 'v' || conv_id || '-' || turn AS item_id, 'at_discovery' AS snapshot_kind, {AS_OF} AS snapshot_date,
  conv_id || '-' || turn || '-' || i AS comment_id,
  CASE WHEN trim(s, ' ') <> '' THEN trim(s, ' ') ELSE 'part ' || i END AS text,
  CASE WHEN i % 4 <> 3 THEN length(s) END AS like_count, i AS total_reply_count, role AS author_display_name,
  '2024-01-02 03:04:05' AS published_at, i + 1 AS rank, {NOW} AS collected_at FROM s"""
_SEEN = f"{_P} % 31 <> 0"
ORACLES["flatten_movies_json"] = (
    f"SELECT {_P} AS movie_id, p_name AS title, CASE WHEN {_P} % 5 = 0 THEN DATE '2024-06-01' ELSE"
    f" {_day('2024-02-01', f'{_P} % 100')} END AS release_date, CAST(90 + p_size AS BIGINT) AS runtime_minutes, 'Planned' AS status,"
    f" {r6('p_retailprice')} AS popularity, '/p' || {_P} || '.jpg' AS poster_path, 'C' || {_P} % 9 || '|ZZ' AS"
    f" origin_countries, p_size || '/' || p_type || '|' || (p_size + 1) || '/' || CASE WHEN {_P} % 2 = 0 THEN 'second'"
    f" ELSE '' END AS genres, CASE WHEN {_P} % 5 <> 0 THEN {_P} % 7 || '/co' || {_P} % 7 || '/-/US|100/' || p_brand ||"
    f" '/-/-' ELSE '' END AS production_companies, CASE WHEN {_P} % 4 <> 0 THEN 'en/English/English|l' || {_P} % 3 ||"
    f" '/-/other' ELSE '' END AS spoken_languages FROM part WHERE {_SEEN}"
)


def _video_rows(tag: str) -> str:
    return (
        f"SELECT {_P}, p_size, i, '{tag}' || {_P} || '-' || i % 3 AS item_id,"
        " ['YouTube', 'youtube', 'Vimeo'][(i + p_size) % 3 + 1] AS site,"
        " ['Trailer', 'Teaser', 'Clip', 'Trailer'][(i + p_size) % 4 + 1] AS typ,"
        " CASE WHEN i % 2 = 0 THEN 'Cut ' || i || ' OFFICIAL Trailer' ELSE 'Cut ' || i END AS name, i % 2 = 0 AS official"
        f" FROM (SELECT *, unnest(range(0, {_P} % 4 + 1)) AS i FROM part)"
    )


_RELEASE = f"CASE WHEN {_P} % 5 = 0 THEN DATE '2024-06-01' ELSE {_day('2024-02-01', f'{_P} % 100')} END"
_KIND = "CASE WHEN i % 2 = 0 THEN 'Official Trailer' ELSE typ END"
ORACLES["flatten_movie_items_json"] = (
    f"SELECT item_id, 'movie' AS content_kind, {_P} AS movie_id, {_KIND} AS video_type, name,"
    f" '2024-01-0' || (i + 1) || ' 00:00:00' AS published_at, official, {_RELEASE} AS tracking_end_date,"
    f" 'active' AS tracking_status FROM ({_video_rows('m')}) WHERE {_SEEN} AND {_P} % 37 <> 0 AND site <> 'Vimeo'"
    " AND typ <> 'Clip' QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY i DESC) = 1"
)
ORACLES["flatten_providers_json"] = f"""WITH r AS (
  SELECT {_P} AS p, unnest(CASE WHEN {_P} % 3 = 0 THEN ['US'] ELSE ['US', 'GB'] END) AS region
  FROM part WHERE {_SEEN} AND {_P} % 10 <> 0)
SELECT p AS title_id, 'movie' AS content_kind, region, 'flatrate' AS kind, p % 30 AS provider_id,
  'n' || p % 30 AS provider_name, p % 4 AS display_priority, 'l' || p AS link, {NOW} AS collected_at
FROM r WHERE p % 30 <> 0
UNION ALL SELECT p, 'movie', region, 'rent', 100 + p % 5, 'r', 1, 'l' || p, {NOW} FROM r WHERE p % 2 = 0"""
ORACLES["flatten_credits_json"] = f"""WITH c AS (
  SELECT {_P} AS p, unnest(range(0, p_size % 14 + 1)) AS i FROM part WHERE {_SEEN}),
cst AS (
  SELECT *, CASE WHEN i % 6 <> 5 THEN i * 7 % 13 END AS o FROM c WHERE p * 100 + i <> 0
  QUALIFY row_number() OVER (PARTITION BY p ORDER BY coalesce(o, 99999), i) <= 10),
w AS (SELECT {_P} AS p, unnest(range(0, p_size % 9 + 1)) AS i FROM part WHERE {_SEEN}),
crew AS (
  SELECT p, p * 100 + 50 + i % 3 AS id, 'w' || min(i) AS name,
    array_to_string(list_sort(list_distinct(list(['Director', 'Writer', 'Foley', 'Producer'][i % 4 + 1]))), ', ') AS job,
    'dep' || min(i) AS department FROM w WHERE i % 4 <> 2 GROUP BY ALL)
SELECT p AS title_id, 'movie' AS content_kind, 'cast' AS credit_kind, p * 100 + i AS person_id, 'a' || i AS name,
  'c' || i AS character, CAST(NULL AS VARCHAR) AS job, 'Acting' AS department, o AS order_index, {NOW} AS collected_at
FROM cst UNION ALL SELECT p, 'movie', 'crew', id, name, NULL, job, department, 0, {NOW} FROM crew"""
ORACLES["flatten_shows_json"] = (
    f"SELECT {_P} AS tv_id, p_name AS name, DATE '2024-03-01' AS first_air_date, CASE WHEN {_P} % 3 = 0 THEN 'KR'"
    f" ELSE 'C' || {_P} % 9 || '|ZZ' END AS origin_countries, {r6('p_retailprice')} AS popularity FROM part"
)
_SEASON_CTE = f"""sn AS (
  SELECT {_P} AS p, i AS n, CASE (i + {_P}) % 5 WHEN 4 THEN {_day('2024-02-01', f'({_P} + i) % 50')} END AS air
  FROM (SELECT *, unnest(range(0, p_size % 4 + 1)) AS i FROM part) WHERE i <> 0 AND (i + {_P}) % 5 IN (0, 1, 4))"""
ORACLES["flatten_seasons_json"] = (
    f"WITH {_SEASON_CTE} SELECT p AS tv_id, n AS season_number, 'S' || n AS name, air AS air_date,"
    " 6 + n AS episode_count FROM sn"
)
ORACLES["flatten_tv_items_json"] = f"""WITH {_SEASON_CTE},
anchor AS (SELECT * FROM sn QUALIFY row_number() OVER (PARTITION BY p ORDER BY air NULLS LAST, n) = 1),
x AS (
  SELECT 's' || p || '-' || n AS item_id, p AS tv_id, n AS season_number, 'Trailer' AS video_type,
    'Season ' || n AS name, true AS official, air AS tracking_end_date, 0 AS level, n * 10 AS pos FROM sn
  UNION ALL SELECT 't' || p || '-1', p, n, 'Teaser', 'Shared ' || n, false, air, 0, n * 10 + 1 FROM sn
  UNION ALL SELECT item_id, {_P}, n, {_KIND}, name, official, air, 1, i FROM ({_video_rows('t')})
    JOIN anchor ON p = {_P} WHERE site <> 'Vimeo' AND typ <> 'Clip')
SELECT item_id, tv_id, season_number, video_type, name, official, tracking_end_date FROM x
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY level DESC, pos DESC) = 1"""
ORACLES["discovery_merge"] = q(
    f"""SELECT coalesce(i.item_id, f.item_id) AS item_id, coalesce(i.content_kind, 'movie') AS content_kind,
  CASE WHEN i.item_id IS NULL THEN f.p ELSE i.movie_id END AS movie_id,
  CASE WHEN f.item_id IS NOT NULL THEN f.released ELSE i.tracking_end_date END AS tracking_end_date,
  coalesce(i.tracking_status, 'active') AS tracking_status, i.channel_title
FROM items i FULL JOIN (
  SELECT DISTINCT 'v' || {_P} AS item_id, {_P} AS p, {_RELEASE} AS released FROM ({_video_rows('m')})
  WHERE {_SEEN} AND {_P} % 37 <> 0 AND site <> 'Vimeo' AND typ <> 'Clip') f ON i.item_id = f.item_id"""
)
ORACLES["counter_run_items"] = q(
    f"""SELECT item_id, CASE WHEN s = 'active' AND {AS_OF} > tracking_end_date + 30 THEN 'ended' ELSE s END
    AS tracking_status,
  CASE WHEN got THEN 'ch' || c % 40 END AS channel_id,
  CASE WHEN got AND c % 6 <> 0 THEN 'seen' ELSE channel_title END AS channel_title,
  CASE WHEN got THEN {_THUMB.replace('c_custkey', 'c')} END AS thumbnail_url,
  CASE WHEN got THEN coalesce({_DURATION.replace('c_custkey', 'c')}, duration_seconds) ELSE duration_seconds END
    AS duration_seconds,
  CASE WHEN got AND c % 12 = 0 THEN 'RU|KP' ELSE region_blocked END AS region_blocked,
  CASE WHEN got OR lost THEN {NOW} END AS last_collected_at
FROM (SELECT *, wanted AND c % 29 <> 0 AS got, wanted AND c % 29 = 0 AS lost,
    CASE WHEN wanted AND c % 29 = 0 THEN 'unavailable' ELSE tracking_status END AS s
  FROM (SELECT *, item_id IN (SELECT item_id FROM active) AS wanted FROM items))""",
    _ACTIVE,
)
ORACLES["table_merge"] = q(
    f"""SELECT coalesce(n.item_id, s.item_id) AS item_id, coalesce(n.collected_date, s.collected_date) AS collected_date,
  CASE WHEN n.item_id IS NULL THEN s.view_count ELSE n.view_count END AS view_count,
  CASE WHEN n.item_id IS NULL THEN s.like_count ELSE n.like_count END AS like_count,
  CASE WHEN n.item_id IS NULL THEN s.comment_count ELSE n.comment_count END AS comment_count,
  CAST(0 AS BIGINT) AS favorite_count
FROM snaps s FULL JOIN (
  SELECT 'v' || c_custkey AS item_id, {AS_OF} AS collected_date, c_custkey * 13 AS view_count, {_LIKES} AS like_count,
    {_REPLIES} AS comment_count {_BACK}) n
  ON s.item_id = n.item_id AND s.collected_date = n.collected_date"""
)
ORACLES["counter_run_snapshots"] = q(
    f"""SELECT coalesce(n.item_id, s.item_id) AS item_id, coalesce(n.collected_date, s.collected_date) AS collected_date,
  CASE WHEN n.item_id IS NULL THEN s.view_count ELSE n.view_count END AS view_count,
  CASE WHEN n.item_id IS NULL THEN s.like_count ELSE n.like_count END AS like_count,
  CASE WHEN n.item_id IS NULL THEN s.comment_count ELSE n.comment_count END AS comment_count,
  CAST(0 AS BIGINT) AS favorite_count
FROM snaps s FULL JOIN (
  SELECT 'v' || c_custkey AS item_id, {AS_OF} AS collected_date, c_custkey * 13 AS view_count, {_LIKES} AS like_count,
    {_REPLIES} AS comment_count {_BACK} AND 'v' || c_custkey IN (SELECT item_id FROM active)) n
  ON s.item_id = n.item_id AND s.collected_date = n.collected_date""",
    _ACTIVE,
)
_REJECT = (
    "CASE WHEN c_custkey % 13 = 0 OR c_custkey % 17 = 0 THEN 'unreadable' WHEN c_custkey % 19 = 0 THEN 'other_id' END"
)
_ASKED = "'v' || c_custkey IN (SELECT item_id FROM active)"
ORACLES["flatten_rejects"] = q(
    f"SELECT 'stats' AS phase, 'v' || c_custkey AS item_id, {_REJECT} AS reason, {AS_OF} AS rejected_date"
    f" {_BACK} AND {_ASKED} AND {_REJECT} IS NOT NULL",
    _ACTIVE,
)
ORACLES["counter_run_faulty"] = q(
    f"SELECT 'v' || c_custkey AS item_id, c_custkey * 13 AS view_count, {_LIKES} AS like_count, {_REPLIES} AS comment_count"
    f" {_BACK} AND {_ASKED} AND {_REJECT} IS NULL",
    _ACTIVE,
)
_DUE = f"due_items AS (SELECT *, coalesce({_DISC}, false) AS disc, coalesce({_PRE}, false) AS pre FROM items)"
ORACLES["comment_run_items"] = q(
    f"""SELECT item_id, comments_disabled OR ((disc OR pre) AND c % 10 = 4) AS comments_disabled,
  CASE WHEN disc AND c % 10 NOT IN (4, 5) THEN {NOW} ELSE {txt('disc_at')} END AS comments_at_discovery_captured_at,
  CASE WHEN pre AND c % 10 NOT IN (4, 5) THEN {NOW} ELSE {txt('pre_at')} END AS comments_pre_release_captured_at,
  CASE WHEN (disc OR pre) AND c % 10 = 4 THEN {NOW} END AS last_collected_at FROM due_items""",
    _DUE,
)
ORACLES["comment_run_rows"] = q(
    f"""SELECT coalesce(n.item_id, c.item_id) AS item_id, coalesce(n.snapshot_kind, c.snapshot_kind) AS snapshot_kind,
  coalesce(n.comment_id, c.comment_id) AS comment_id,
  CASE WHEN n.item_id IS NULL THEN c.snapshot_date ELSE {AS_OF} END AS snapshot_date,
  CASE WHEN n.item_id IS NULL THEN c.rank ELSE n.rank END AS rank,
  CASE WHEN n.item_id IS NULL THEN c.like_count ELSE n.like_count END AS like_count
FROM comments c FULL JOIN (
  SELECT item_id, kind AS snapshot_kind, c || '-' || i AS comment_id, i + 1 AS rank, c % 50 + i AS like_count, {AS_OF} AS d
  FROM (SELECT *, unnest(range(0, c % 4 + 1)) AS i FROM due_items), (VALUES ('at_discovery'), ('pre_release')) AS k(kind)
  WHERE c % 10 NOT IN (4, 5) AND CASE kind WHEN 'at_discovery' THEN disc ELSE pre END) n
  ON c.item_id = n.item_id AND c.snapshot_kind = n.snapshot_kind AND c.comment_id = n.comment_id
  AND c.snapshot_date = n.d""",
    _DUE,
)
_WS = r"[\p{Z}\t\n\v\f\r\x1c-\x1f\x{85}]"
_WORDS = f"list_filter(string_split_regex(text, '{_WS}+'), lambda w: w <> '')"
_ATT = "CASE WHEN doc_id % 3 = 0 THEN 'yta' WHEN doc_id % 3 = 1 THEN 'whisper' ELSE 'failed' END"
ORACLES["transcript_run_items"] = q(
    f"SELECT item_id, CASE WHEN transcript_at IS NULL AND tracking_status = 'active' AND c IN (SELECT doc_id FROM"
    f" documents) THEN {NOW} ELSE {txt('transcript_at')} END AS transcript_captured_at FROM items"
)
ORACLES["transcript_rows"] = f"""SELECT 'v' || doc_id AS item_id, {_ATT} AS source,
  CASE WHEN doc_id % 3 = 0 THEN CASE WHEN doc_id % 2 = 0 THEN 'manual' ELSE 'auto-generated' END
    WHEN doc_id % 3 = 1 THEN CASE WHEN n_chars % 2 = 0 THEN 'speech' ELSE 'music' END END AS track_kind,
  CASE WHEN doc_id % 3 = 0 THEN 'en' WHEN doc_id % 3 = 1 THEN lang END AS language,
  CASE WHEN doc_id % 3 <> 2 THEN len({_WORDS}) END AS word_count,
  CASE WHEN doc_id % 3 <> 2 THEN length(text) END AS char_count,
  CASE WHEN doc_id % 3 = 2 THEN 'yta=IpBlocked; whisper=' || CASE WHEN doc_id % 2 = 0 THEN ': odd' ELSE 'None' END END
    AS error, {NOW} AS captured_at FROM documents"""
ORACLES["duration_parse"] = (
    f"SELECT 'v' || c_custkey AS item_id, {_DURATION_TEXT} AS duration, {_DURATION} AS seconds {_BACK}"
)
ORACLES["word_counts"] = f"SELECT doc_id, len({_WORDS}) AS words, length(text) AS chars FROM documents"
_TOKENS = (
    r"list_distinct(list_filter(string_split_regex(regexp_replace(lower(text), '[^\p{L}\p{N}_''\p{Z}\t\n\v\f\r\x1c-\x1f\x{85}]',"
    f" ' ', 'g'), '{_WS}+'), lambda w: w <> ''))"
)
ORACLES["jaccard_pairs"] = f"""WITH t AS (SELECT doc_id, {_TOKENS} AS s FROM documents),
p AS (SELECT a.doc_id, len(list_intersect(a.s, b.s)) AS k, len(a.s) AS na, len(b.s) AS nb
  FROM t a JOIN t b ON b.doc_id = a.doc_id + 1)
SELECT doc_id, CASE WHEN na = 0 AND nb = 0 THEN 1.0 WHEN na = 0 OR nb = 0 THEN 0.0
  ELSE round(k / (na + nb - k), 3) END AS similarity FROM p"""
_HYPE = (
    "cant wait|can''t wait|cannot wait|hype|hyped|insane|peak|goosebump|masterpiece|cinema|goat|fire|banger|chills|"
    "epic|amazing|incredible|perfect|legend|crazy|best|love|excited|finally|need this|day one"
)


def _hype_points(text: str) -> str:
    # non-ASCII word characters become '_', other non-ASCII a blank, so ASCII word boundaries are right
    plain = (
        rf"regexp_replace(regexp_replace({text}, '[^\x00-\x7f\p{{L}}\p{{N}}]', ' ', 'g'), '[^\x00-\x7f]', '_', 'g')"
    )
    emoji = r"[\x{1F525}\x{1F60D}\x{1F929}\x{1F62D}\x{2764}\x{FE0F}\x{1F979}\x{1F64C}\x{1F4AF}\x{1F44F}\x{1F631}\x{26A1}\x{1F3AC}]"
    return (
        f"(len(regexp_extract_all({text}, '!')) + len(regexp_extract_all({plain}, '\\b[A-Z]{{3,}}\\b'))"
        f" + 2 * len(regexp_extract_all({plain}, '(?i)\\b({_HYPE})\\b')) + len(regexp_extract_all({text}, '{emoji}')))"
    )


ORACLES["lexicon_rate"] = (
    f"SELECT source, count(*) AS texts, {r6('avg(p)')} AS rate, CAST(max(p) AS DOUBLE) AS most"
    f" FROM (SELECT source, {_hype_points('text')} AS p FROM documents) GROUP BY source"
)
ORACLES["preview_rows"] = (
    f"SELECT doc_id, array_to_string({_WORDS}[1:5], '|') AS words,"
    " CASE WHEN length(text) > 200 THEN substring(text, 1, 200) || '…' ELSE text END AS text FROM documents"
)
ORACLES["json_rows"] = q(
    """SELECT '{"item_id":"' || item_id || '","collected_date":"' || collected_date || '","view_count":' || view_count
  || ',"like_count":' || coalesce(CAST(like_count AS VARCHAR), 'null') || ',"collected_at":"' || collected_date
  || 'T00:00:00Z"}' AS value FROM snaps"""
)
ORACLES["unit_vectors"] = f"""WITH x AS (
  SELECT vec_id, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS dim FROM embeddings)
SELECT vec_id, dim, {r6('CAST(e AS DOUBLE) / greatest(sqrt(sum(CAST(e AS DOUBLE) * e) OVER (PARTITION BY vec_id)), 1e-9)')} AS x
FROM x"""
_DISC_C = "dc AS (SELECT * FROM comments WHERE snapshot_kind = 'at_discovery' AND text IS NOT NULL)"
_SETS = (
    _DISC_C + ", sets AS (SELECT item_id, count(*) AS n_comments, avg(like_count) AS mean_like_count,"
    " max(snapshot_date) AS source_snapshot_date FROM dc GROUP BY item_id),"
    " top30 AS (SELECT * FROM dc QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY rank, comment_id) <= 30)"
)
ORACLES["comment_sets"] = q(
    f"SELECT item_id, n_comments, {r6('mean_like_count')} AS mean_like_count, source_snapshot_date,"
    " (SELECT string_agg(CAST(rank AS VARCHAR), '|' ORDER BY rank) FROM top30 t WHERE t.item_id = sets.item_id) AS ranks"
    " FROM sets",
    _SETS,
)
ORACLES["training_set"] = q(
    f"SELECT item_id, movie_id, m.title, {txt('published_at')} AS published_at,"
    " (SELECT string_agg(text, '|' ORDER BY rank) FROM top30 t WHERE t.item_id = sets.item_id) AS comments"
    " FROM sets JOIN links USING (item_id) LEFT JOIN movies m USING (movie_id)"
    " WHERE n_comments >= 3 AND links.published_at IS NOT NULL",
    _SETS,
)
_POOL = (
    _DISC_C
    + """, best30 AS (SELECT * FROM dc QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY rank, comment_id) <= 30),
ev AS (
  SELECT b.*, CASE WHEN sum(ln(1 + like_count)) OVER (PARTITION BY item_id) > 0 THEN ln(1 + like_count) ELSE 1.0 END AS w,
    (conv_id * 31 + turn) % (SELECT max(vec_id) + 1 FROM embeddings) AS vec_id
  FROM best30 b WHERE trim(text) <> ''),
ex AS (
  SELECT item_id, w, unnest(embedding) AS e, generate_subscripts(embedding, 1) - 1 AS dim
  FROM ev JOIN embeddings USING (vec_id)),
aux AS (
  SELECT item_id, ln(1 + avg(like_count)) AS a, ln(1 + count(*)) AS b, avg("""
    + _hype_points("text")
    + """) AS h FROM ev GROUP BY item_id),
pooled AS (
  SELECT item_id, dim, sum(w * CAST(e AS DOUBLE)) / sum(w) AS x FROM ex GROUP BY ALL
  UNION ALL SELECT item_id, 64, a FROM aux UNION ALL SELECT item_id, 65, b FROM aux
  UNION ALL SELECT item_id, 66, h FROM aux)"""
)
ORACLES["pooled_features"] = q(f"SELECT item_id, dim, {r6('x')} AS x FROM pooled", _POOL)
_HEAD = (
    ", scored AS (SELECT item_id, greatest(0.0, least(100.0, 40.0 + sum((x - 0.01 * (dim % 5)) / (0.5 + 0.1 * (dim % 3))"
    " * ((dim * 7) % 13 - 6) * 2.0))) AS excitement FROM pooled GROUP BY item_id)"
)
ORACLES["head_roundtrip"] = q(f"SELECT item_id, {r6('excitement')} AS excitement FROM scored", _POOL + _HEAD)
ORACLES["linear_scores"] = q(f"SELECT item_id, {r6('excitement')} AS excitement FROM scored", _POOL + _HEAD)
ORACLES["scoring_job"] = q(
    f"SELECT item_id, 'h1' AS model_version, {AS_OF} AS scored_date, round(excitement, 2) AS excitement,"
    f" 'at_discovery' AS snapshot_kind, count(*) AS n_comments, {r6('avg(like_count)')} AS mean_like_count,"
    f" max(snapshot_date) AS source_snapshot_date, {NOW} AS created_at FROM scored JOIN dc USING (item_id)"
    " GROUP BY item_id, excitement",
    _POOL + _HEAD,
)
ORACLES["scoring_job_merged"] = q(
    f"""SELECT model_version, scored_date, count(*) AS n FROM (
  SELECT CASE WHEN model_version = 'm2' AND CAST(substr(item_id, 2) AS BIGINT) % 3 <> 0 THEN 'h1' ELSE model_version END
    AS model_version, scored_date FROM scores
  UNION ALL SELECT 'h1', {AS_OF} FROM (SELECT DISTINCT item_id FROM dc WHERE item_id NOT IN
    (SELECT item_id FROM scores WHERE CAST(substr(item_id, 2) AS BIGINT) % 3 <> 0 AND model_version = 'm2'))) GROUP BY ALL""",
    _DISC_C,
)
ORACLES["feature_table"] = q(
    f"SELECT item_id, movie_id, CAST(label * 10 AS DOUBLE) AS y, dim, {r6('x')} AS x FROM pooled"
    " JOIN links USING (item_id) JOIN embeddings ON item_id = 'v' || vec_id",
    _POOL,
)
ORACLES["fit_quality"] = q(
    f"""SELECT count(*) AS n, {r6('avg(abs(p - y))')} AS mae, {r6('sqrt(avg((p - y) * (p - y)))')} AS rmse,
  {r6('avg(abs(y - m))')} AS baseline_mae, {r6('corr(ry, rp)')} AS spearman FROM (
  SELECT *, avg(y) OVER () AS m, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2 AS ry,
    rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS rp
  FROM (SELECT round(a.excitement) AS y, round(b.excitement) AS p FROM scores a JOIN scores b USING (item_id)
    WHERE a.model_version = 'm1' AND b.model_version = 'm2' AND a.excitement IS NOT NULL))"""
)
ORACLES["ridge_small"] = f"""WITH raw AS (
  SELECT vec_id, vec_id % 97 % 5 AS fold, CAST(embedding[1] AS DOUBLE) AS x1, CAST(embedding[2] AS DOUBLE) AS x2,
    50 + 100 * CAST(embedding[1] AS DOUBLE) - 60 * CAST(embedding[2] AS DOUBLE) + label AS y FROM embeddings),
d AS (SELECT vec_id, fold, y, (x1 - avg(x1) OVER ()) / stddev_pop(x1) OVER () AS z1,
  (x2 - avg(x2) OVER ()) / stddev_pop(x2) OVER () AS z2 FROM raw),
fits AS (SELECT DISTINCT fold AS f FROM d UNION ALL SELECT -1),
mom AS (SELECT f, count(*) AS n, avg(z1) AS c1, avg(z2) AS c2, avg(y) AS my, count(*) * var_pop(z1) AS s11,
  count(*) * var_pop(z2) AS s22, count(*) * covar_pop(z1, z2) AS s12, count(*) * covar_pop(z1, y) AS t1,
  count(*) * covar_pop(z2, y) AS t2 FROM fits JOIN d ON fold <> f GROUP BY f),
grid AS (SELECT i, pow(10, -1 + 5 * i / 23) AS a FROM (SELECT unnest(range(24)) AS i)),
sol AS (SELECT *, (s11 + a) * (s22 + a) - s12 * s12 AS det FROM mom, grid),
coef AS (SELECT *, ((s22 + a) * t1 - s12 * t2) / det AS b1, ((s11 + a) * t2 - s12 * t1) / det AS b2 FROM sol),
loo AS (SELECT f, i, any_value(b1) AS b1, any_value(b2) AS b2, any_value(c1) AS c1, any_value(c2) AS c2, any_value(my) AS my,
  sum(pow((y - my - b1 * (z1 - c1) - b2 * (z2 - c2)) / (1 - 1 / n
    - ((s22 + a) * (z1 - c1) * (z1 - c1) - 2 * s12 * (z1 - c1) * (z2 - c2) + (s11 + a) * (z2 - c2) * (z2 - c2)) / det), 2)) AS e
  FROM coef JOIN d ON fold <> f GROUP BY f, i),
best AS (SELECT * FROM loo QUALIFY row_number() OVER (PARTITION BY f ORDER BY e, i) = 1),
o AS (SELECT y, greatest(0, least(100, my + b1 * (z1 - c1) + b2 * (z2 - c2))) AS p FROM d JOIN best ON f = fold)
SELECT count(*) AS n, {r6('avg(abs(p - y))')} AS mae, {r6('sqrt(avg((p - y) * (p - y)))')} AS rmse,
  {r6('avg(abs(y - m))')} AS baseline_mae, {r6('corr(ry, rp)')} AS spearman FROM (
  SELECT *, avg(y) OVER () AS m, rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2 AS ry,
    rank() OVER (ORDER BY p) + (count(*) OVER (PARTITION BY p) - 1) / 2 AS rp FROM o)"""
ORACLES["run_log"] = q(
    f"""SELECT phase, max(n) FILTER (WHERE k = 1) OVER (PARTITION BY phase) AS items_processed, CAST(0 AS BIGINT) AS errors, outcome, n
FROM (
  SELECT 'stats' AS phase, unnest([1, 2, 3]) AS k, unnest(['counted', 'rejected', 'unavailable']) AS outcome,
    unnest([count(*) FILTER (WHERE c_custkey % 29 <> 0 AND {_REJECT} IS NULL),
      count(*) FILTER (WHERE c_custkey % 29 <> 0 AND {_REJECT} IS NOT NULL), count(*) FILTER (WHERE c_custkey % 29 = 0)]) AS n
  FROM customer WHERE {_ASKED}
  UNION ALL
  SELECT 'comments', unnest([1, 2, 3, 4, 5]), unnest(['comments', 'at_discovery', 'pre_release', 'disabled', 'failed']),
    unnest([CAST(coalesce(sum(CASE WHEN c % 10 NOT IN (4, 5) THEN (CAST(disc AS INT) + CAST(pre AS INT)) * (c % 4 + 1) END), 0) AS BIGINT),
      count(*) FILTER (WHERE disc AND c % 10 NOT IN (4, 5)), count(*) FILTER (WHERE pre AND c % 10 NOT IN (4, 5)),
      count(*) FILTER (WHERE disc AND c % 10 = 4) + count(*) FILTER (WHERE pre AND c % 10 = 4),
      count(*) FILTER (WHERE disc AND c % 10 = 5) + count(*) FILTER (WHERE pre AND c % 10 = 5)])
  FROM (SELECT * FROM due_items WHERE {{after_stats}})
  UNION ALL
  SELECT 'excitement', unnest([1, 2]), unnest(['scored', 'skipped']),
    unnest([count(*) FILTER (WHERE CAST(substr(item_id, 2) AS BIGINT) % 5 <> 0), count(*) FILTER (WHERE CAST(substr(item_id, 2) AS BIGINT) % 5 = 0)])
  FROM (SELECT DISTINCT item_id FROM comments WHERE snapshot_kind = 'at_discovery')
  UNION ALL
  SELECT 'transcripts', unnest([1, 2, 3, 4]), unnest(['attempted', 'yta', 'whisper', 'failed']),
    unnest([count(*), count(*) FILTER (WHERE a = 'yta'), count(*) FILTER (WHERE a = 'whisper'), count(*) FILTER (WHERE a = 'failed')])
  FROM (SELECT {_ATT} AS a FROM documents WHERE 'v' || doc_id IN (SELECT item_id FROM items WHERE transcript_at IS NULL
    AND tracking_status = 'active' AND {{after_stats}})))""".replace(
        "{after_stats}",
        # the counter job has ended or lost these before the other jobs look
        f"NOT (item_id IN (SELECT item_id FROM active) AND c % 29 = 0) AND NOT coalesce({AS_OF} > tracking_end_date + 30, false)",
    ),
    f"{_ACTIVE}, {_DUE}",
)
_GATE = f"""lex AS (
  SELECT item_id, avg({_hype_points('text')}) AS h FROM (
    SELECT * FROM comments WHERE snapshot_kind = 'at_discovery'
    QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY rank, comment_id) <= 30) GROUP BY item_id),
o AS (
  SELECT movie_id, s.excitement, h, row_number() OVER (PARTITION BY movie_id ORDER BY published_at, s.item_id) AS k
  FROM scores s JOIN lex USING (item_id) JOIN links USING (item_id)
  WHERE model_version = 'm1' AND excitement IS NOT NULL AND published_at IS NOT NULL),
u AS (
  SELECT movie_id, count(*) AS n, arg_max(excitement, k) - arg_min(excitement, k) AS delta,
    arg_max(h, k) - arg_min(h, k) AS hd, regr_slope(excitement, k) AS sl, regr_slope(h, k) AS hsl
  FROM o GROUP BY movie_id HAVING count(*) >= 2)"""
ORACLES["acceptance_summary"] = q(
    f"""SELECT 'excitement' AS score, count(*) AS movies, count(*) FILTER (WHERE delta < 0) AS declined,
  {r6('avg(sl)')} AS mean_slope, {r6('median(delta)')} AS median_delta FROM u
UNION ALL SELECT 'lexicon', count(*), count(*) FILTER (WHERE hd < 0), {r6('avg(hsl)')}, {r6('median(hd)')} FROM u""",
    _GATE,
)
ORACLES["acceptance_gate"] = q(
    f"""SELECT 'decline_rate' AS "check", {r6('d')} AS value, d >= 0.55 AS passed FROM f
UNION ALL SELECT 'median_delta', {r6('md')}, md < 0 FROM f
UNION ALL SELECT 'dose_response', {r6('m5 - m2')}, coalesce(m5 < m2, true) FROM f
UNION ALL SELECT 'proxy_blind', {r6('pd')}, pd < 0.58 FROM f""",
    _GATE + """,
f AS (
  SELECT count(*) FILTER (WHERE delta < 0) / count(*) AS d, median(delta) AS md,
    median(delta) FILTER (WHERE n >= 5) AS m5, median(delta) FILTER (WHERE n = 2) AS m2,
    count(*) FILTER (WHERE hd < 0) / count(*) AS pd FROM u)""",
)
ORACLES["item_windows"] = q(
    "SELECT item_id, CAST(s / 15 AS BIGINT) AS window_index, s AS start_seconds"
    " FROM (SELECT item_id, unnest(range(0, duration_seconds - 5, 15)) AS s FROM items)"
)
_MATCH = """m AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS item_id, l_returnflag AS method, l_discount >= 0.05 AS success,
    CASE WHEN l_partkey % 17 <> 0 THEN 't' || l_partkey % 40 ELSE '' END AS title, 'a' || l_suppkey % 10 AS artist,
    l_tax AS score, CAST(l_linenumber * 15 AS BIGINT) AS start_seconds, l_quantity AS latency FROM lineitem)"""
ORACLES["window_report"] = (
    f"WITH {_MATCH} SELECT method, count(*) AS windows_tested, count(*) FILTER (WHERE success) AS windows_matched,"
    f" {r6('count(*) FILTER (WHERE success) / count(*) * 100')} AS hit_rate_pct,"
    " count(DISTINCT CASE WHEN success THEN item_id END) AS items_with_hit, count(DISTINCT item_id) AS items,"
    f" {r6('avg(latency)')} AS mean_latency FROM m GROUP BY method"
)
ORACLES["window_report_by_item"] = (
    f"WITH {_MATCH} SELECT item_id, method, count(*) AS windows, count(*) FILTER (WHERE success) AS hits,"
    " count(DISTINCT CASE WHEN success AND title <> '' THEN title || '/' || artist END) AS tracks FROM m GROUP BY ALL"
)
ORACLES["identified_tracks"] = (
    f"WITH {_MATCH} SELECT item_id, method, title, artist, start_seconds, {r6('score')} AS score FROM m WHERE success"
    " QUALIFY row_number() OVER (PARTITION BY item_id, method, title, artist ORDER BY start_seconds, score) = 1"
)
ORACLES["transcript_methods"] = f"""SELECT {_ATT} AS method, count(*) AS total,
  count(*) FILTER (WHERE doc_id % 3 <> 2) AS successes,
  {r6('avg(CASE WHEN doc_id % 3 <> 2 THEN length(text) ELSE 0 END / 1000)')} AS mean_latency,
  {r6(f'avg(CASE WHEN doc_id % 3 <> 2 THEN len({_WORDS}) END)')} AS mean_words FROM documents GROUP BY ALL"""
ORACLES["daily_counters_stream"] = (
    "SELECT 'v' || user_id AS item_id, CAST(ts AS DATE) AS day, count(*) AS views,"
    " count(*) FILTER (WHERE event_type = 'click') AS likes,"
    " count(*) FILTER (WHERE event_type = 'purchase') AS comments FROM events GROUP BY ALL"
)
ORACLES["daily_counters_out_of_order"] = ORACLES["daily_counters_stream"]
ORACLES["merge_repeated_keys"] = (
    "SELECT user_id AS k, max(event_id) AS at, arg_max(event_type, event_id) AS kind FROM events GROUP BY user_id"
)
ORACLES["snapshots_stream"] = q("SELECT item_id, view_count, like_count, comment_count, collected_date FROM snaps")
ORACLES["labels_join"] = q(
    "SELECT item_id, CAST(label * 10 AS DOUBLE) AS excitement, content_kind, movie_id FROM embeddings"
    " JOIN items ON item_id = 'v' || vec_id WHERE vec_id % 11 <> 4 AND vec_id % 13 <> 5"
)


def _entries(document: str, source: str, where: str, **values: str) -> str:
    names = ", ".join(f"'{k}'" for k in values)
    numbers = ", ".join(f"CAST({v} AS DOUBLE)" for v in values.values())
    return (
        f"SELECT '{document}' AS document, unnest([{names}]) AS entry, unnest([{numbers}]) AS value"
        f" FROM ({ORACLES[source]}) WHERE {where}"
    )


ORACLES["site_documents"] = " UNION ALL ".join(
    [
        _entries(
            "coverage", "coverage", "true", unique_items="unique_items", countries_covered="countries_covered",
            total_attributions="total_attributions", active_items="active_items",
        ),
        f"SELECT 'coverage', country, CAST(total_items AS DOUBLE) FROM ({ORACLES['top_countries']})",
        _entries("engagement_decay", "engagement_decay_group", "bucket = 'all'", days="45", units="units", losing="losing"),
        f"SELECT 'engagement_decay', '4+ units', CAST(units AS DOUBLE) FROM ({ORACLES['engagement_decay_group']}) WHERE bucket = '4+'",
        _entries("excitement_decay", "score_decay", "bucket = 'all'", movies="movies", declining="declining", m2="1"),
        f"SELECT 'excitement_decay', '2 movies', CAST(movies AS DOUBLE) FROM ({ORACLES['score_decay']}) WHERE bucket = '2'",
        f"SELECT 'excitement_examples', 'm2', CAST(count(*) AS DOUBLE) FROM ({ORACLES['score_examples']})",
    ]
)
