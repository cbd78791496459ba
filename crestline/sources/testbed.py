"""The engagement tables as derived from the generic star-schema files.

Only for checks and benchmarks: attributes the files lack follow from fixed
arithmetic on ids, so every table grows with its source file.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

AS_OF = "2024-01-30"
NOW = "2024-01-30 06:00:00"

# movie of a customer: blocks of 20 customers share 5 movies with 1, 2, 3, 4 and 10 items
MOVIE_OF = (
    "CAST(floor({c} / 20) AS BIGINT) * 5 + CASE WHEN {c} % 20 < 1 THEN 0 WHEN {c} % 20 < 3 THEN 1"
    " WHEN {c} % 20 < 6 THEN 2 WHEN {c} % 20 < 10 THEN 3 ELSE 4 END"
)


def _ts(date_expr: str, seconds: str) -> str:
    return f"cast({date_expr} as timestamp) + make_dt_interval(0, 0, 0, {seconds})"


def _plus(base: str, days: str) -> str:
    return f"date_add(date'{base}', cast({days} as int))"


#: titles whose documents one task writes and flattens
TITLES = 5_000


@dataclass
class Testbed:
    __test__ = False

    spark: SparkSession
    root: str

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{name}.parquet")

    @cached_property
    def items(self) -> DataFrame:
        c = "c_custkey"
        return self.raw("customer").selectExpr(
            f"concat('v', {c}) as item_id",
            f"case when {c} % 7 = 6 then 'tv' else 'movie' end as content_kind",
            f"case when {c} % 7 <> 6 then {MOVIE_OF.format(c=c)} end as movie_id",
            f"case when {c} % 7 = 6 then {c} % 150 end as tv_id",
            f"case when {c} % 7 = 6 then {c} % 3 + 1 end as season_number",
            f"case {c} % 3 when 0 then 'Teaser' when 1 then 'Trailer' else 'Official Trailer' end as video_type",
            "c_name as name",
            f"case when {c} % 23 <> 0 then {_ts(_plus('2023-12-16', f'{c} * 11 % 45'), f'{c} * 37 % 86400')} end"
            " as published_at",
            "c_mktsegment as channel_title",
            f"{c} % 2 = 0 as official",
            f"case when {c} % 13 <> 0 then {_plus('2023-12-20', f'{c} * 7 % 60')} end as tracking_end_date",
            f"20 + {c} % 150 as duration_seconds",
            f"case when {c} % 5 = 0 then array('KP') else cast(array() as array<string>) end as region_blocked",
            f"{_ts(_plus('2023-12-20', f'{c} % 30'), f'{c} * 41 % 86400')} as first_seen_at",
            "cast(null as timestamp) as last_collected_at",
            f"case when {c} % 10 < 7 then 'active' when {c} % 10 < 9 then 'ended' else 'unavailable' end"
            " as tracking_status",
            f"{c} % 17 = 0 as comments_disabled",
            f"case when {c} % 3 <> 0 then {_ts(_plus('2024-01-01', f'{c} % 20'), '0')} end"
            " as comments_at_discovery_captured_at",
            f"case when {c} % 2 = 0 then {_ts(_plus('2024-01-05', f'{c} % 20'), '0')} end"
            " as comments_pre_release_captured_at",
            f"case when {c} % 4 <> 0 then {_ts(_plus('2024-01-03', f'{c} % 20'), '0')} end as transcript_captured_at",
            "cast(null as string) as channel_id",
            "cast(null as string) as thumbnail_url",
            "cast(null as string) as description",
            "cast(null as string) as definition",
            "cast(null as boolean) as embeddable",
        )

    @cached_property
    def movies(self) -> DataFrame:
        p = "p_partkey"
        return self.raw("part").selectExpr(
            f"{p} as movie_id",
            f"concat(p_name, ' ', {p}) as title",
            f"element_at(array('en', 'hi', 'ta', 'fr', 'en', 'ko'), cast({p} % 6 as int) + 1) as original_language",
            f"{_plus('2024-01-31', f'{p} * 7 % 60 - 10')} as release_date",
            f"case when p_size % 5 <> 0 then concat('/p', {p}, '.jpg') end as poster_path",
            f"case {p} % 6 when 0 then cast(array() as array<string>) when 1 then array('US')"
            f" when 2 then array('US', 'GB') when 3 then array('IN') else array(concat('C', {p} % 9)) end"
            " as origin_countries",
        )

    @cached_property
    def shows(self) -> DataFrame:
        s = self.raw("supplier").join(self.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        return s.selectExpr(
            "s_suppkey as tv_id",
            "s_name as name",
            "case when s_suppkey % 4 <> 0 then concat('/s', s_suppkey, '.jpg') end as poster_path",
            "case when s_suppkey % 8 = 0 then cast(array() as array<string>) else array(n_name) end"
            " as origin_countries",
        )

    @cached_property
    def seasons(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "s_suppkey as tv_id", "explode(array(1L, 2L)) as season_number"
        ).selectExpr(
            "tv_id", "season_number",
            f"{_plus('2024-02-01', 'tv_id % 50 + season_number')} as air_date",
        )

    @cached_property
    def snapshots(self) -> DataFrame:
        """Running totals by user and event day; likes go missing on some days.

        Movies take turns in fading out, taking off late, losing likes, and holding.
        """
        kind = F.col("event_type")
        counted = (
            self.raw("events")
            .groupBy("user_id", F.to_date("ts").alias("collected_date"))
            .agg(
                F.count("*").alias("n"),
                F.count_if(kind == "click").alias("clicks"),
                F.count_if(kind == "purchase").alias("c"),
            )
        )
        turn = F.expr(f"({MOVIE_OF.format(c='user_id')}) % 4")
        d = F.dayofmonth("collected_date")
        views = (
            F.when(turn == 0, F.col("n") * F.greatest(F.lit(1), (30 - d) * 2))
            .when(turn == 1, F.when(d < 24, 2).otherwise(40))
            .otherwise(F.col("n") * 10)
        )
        likes = F.when(turn == 2, F.col("clicks") * F.greatest(F.lit(1), 30 - d * 2)).otherwise(F.col("clicks") * 2)
        daily = counted.select(
            "user_id", "collected_date", views.cast("bigint").alias("v"), likes.cast("bigint").alias("l"), "c"
        )
        upto = Window.partitionBy("user_id").orderBy("collected_date")
        gap = (F.col("user_id") % 11 == 3) & (F.dayofmonth("collected_date") % 7 == 2)
        return daily.select(
            F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("item_id"),
            "collected_date",
            F.sum("v").over(upto).alias("view_count"),
            F.when(~gap, F.sum("l").over(upto)).alias("like_count"),
            F.sum("c").over(upto).alias("comment_count"),
            F.lit(0).cast("bigint").alias("favorite_count"),
            F.col("collected_date").cast("timestamp").alias("collected_at"),
        )

    @cached_property
    def comments(self) -> DataFrame:
        return self.raw("conversations").selectExpr(
            "concat('v', conv_id) as item_id",
            "case when role = 'assistant' then 'pre_release' else 'at_discovery' end as snapshot_kind",
            "case when role = 'assistant' and conv_id % 2 = 0 then date'2024-01-15' else date'2024-01-10' end"
            " as snapshot_date",
            "concat(conv_id, '-', turn) as comment_id",
            "text",
            "cast(length(text) % 97 as bigint) as like_count",
            "turn as total_reply_count",
            "cast(null as string) as author_channel_id",
            "role as author_display_name",
            "cast(null as timestamp) as published_at",
            "cast(null as timestamp) as updated_at",
            "turn + 1 as rank",
            "cast(null as timestamp) as collected_at",
        )

    @cached_property
    def embedded_comments(self) -> DataFrame:
        """Comments with a vector each, picked by arithmetic on conversation and turn."""
        vectors = self.raw("embeddings")
        size = vectors.agg(F.max("vec_id") + 1).scalar()
        ids = F.expr("cast(substring(item_id, 2) as bigint) * 31 + rank - 1")
        return (
            self.comments.withColumn("vec_id", ids % size)
            .join(vectors.select("vec_id", "embedding"), "vec_id")
            .drop("vec_id")
        )

    @cached_property
    def scores(self) -> DataFrame:
        """Two model versions from the first two vector components."""
        base = self.raw("embeddings").selectExpr(
            "vec_id", "label",
            "explode(map('m1', cast(embedding[0] as double), 'm2', cast(embedding[1] as double)))"
            " as (model_version, e)",
        )
        return base.selectExpr(
            "concat('v', vec_id) as item_id",
            "model_version",
            "case model_version when 'm1' then date'2024-01-05' else date'2024-01-20' end as scored_date",
            "case when vec_id % 19 <> 7 then greatest(0D, least(100D, 50D + 100D * e)) end as excitement",
            "'at_discovery' as snapshot_kind",
            "cast(label as bigint) as n_comments",
            "cast(null as double) as mean_like_count",
            "cast(null as date) as source_snapshot_date",
            "cast(null as timestamp) as created_at",
        )

    @cached_property
    def predictions(self) -> DataFrame:
        """One logged call per movie and day out of the orders."""
        o = self.raw("orders").selectExpr(
            "o_orderkey", "o_totalprice",
            f"{MOVIE_OF.format(c='o_custkey')} as movie_id",
            f"{_plus('2023-12-20', 'o_orderkey % 35')} as predicted_at",
            "case when o_orderpriority like '1%' then 7L else 21L end as horizon_days",
            "case o_orderstatus when 'O' then 'open' when 'F' then 'hit' else 'miss' end as status",
        )
        # the lowest order of the day stands for it
        one = o.groupBy("movie_id", "predicted_at").agg(
            F.min(F.struct("o_orderkey", "horizon_days", "status")).alias("f")
        )
        return one.select(
            F.concat_ws("-", F.col("movie_id").cast("string"), F.col("predicted_at").cast("string"))
            .alias("prediction_id"),
            F.lit("trailer_due").alias("kind"), "movie_id", F.lit(None).cast("string").alias("title"),
            "predicted_at", F.col("f.horizon_days").alias("horizon_days"),
            F.lit(None).cast("bigint").alias("days_to_release_at_prediction"),
            F.lit(None).cast("double").alias("vs_peak_at_prediction"),
            F.lit(None).cast("string").alias("basis"), F.col("f.status").alias("status"),
            F.when(F.col("f.status") != "open", F.date_add("predicted_at", 22)).alias("resolved_at"),
            F.lit(None).cast("string").alias("resolved_item_id"),
            F.when(F.col("f.status") == "hit", F.col("f.o_orderkey") % 21).alias("resolved_lag_days"),
            F.lit(None).cast("timestamp").alias("created_at"),
            F.lit(None).cast("timestamp").alias("updated_at"),
        )

    # --- raw documents ------------------------------------------------------------

    @cached_property
    def video_documents(self) -> DataFrame:
        """One statistics document per customer; some customers never come back."""
        c = "c_custkey"
        duration = (
            f"case {c} % 6 when 0 then concat('PT', {c} % 3, 'H', {c} % 60, 'M', {c} % 59, 'S')"
            f" when 1 then concat('PT', {c} % 60, 'M') when 2 then concat('PT', {c} % 90, 'S')"
            f" when 3 then 'PT' when 4 then concat({c} % 60, ':30') else 'P1DT5S' end"
        )
        thumbs = (
            f"named_struct('maxres', case when {c} % 4 = 0 then named_struct('url',"
            f" case when {c} % 8 = 0 then '' else concat('m', {c}) end) end,"
            f" 'high', case when {c} % 3 = 0 then named_struct('url', concat('h', {c})) end,"
            f" 'default', case when {c} % 5 <> 0 then named_struct('url', concat('d', {c})) end)"
        )
        doc = (
            f"named_struct('id', concat('v', {c}), 'statistics', named_struct("
            f"'viewCount', cast({c} * 13 as string), 'likeCount', case when {c} % 9 = 0 then 'n/a'"
            f" else cast({c} % 101 as string) end, 'commentCount', case when {c} % 5 <> 0 then"
            f" cast({c} % 7 as string) end, 'favoriteCount', '0'),"
            f" 'snippet', named_struct('channelId', concat('ch', {c} % 40), 'channelTitle',"
            f" case when {c} % 6 <> 0 then 'seen' end, 'description', c_name, 'thumbnails', {thumbs}),"
            f" 'contentDetails', named_struct('duration', {duration}, 'definition', 'hd', 'regionRestriction',"
            f" case when {c} % 12 = 0 then named_struct('blocked', array('RU', 'KP')) end),"
            f" 'status', named_struct('embeddable', {c} % 2 = 0))"
        )
        return (
            self.raw("customer").filter("c_custkey % 29 <> 0")
            .selectExpr(f"concat('v', {c}) as item_id", f"to_json({doc}) as payload")
        )

    @cached_property
    def turn_threads(self) -> DataFrame:
        """One thread document per conversation turn: its sentences are the comments."""
        doc = (
            "transform(split(text, '[.]'), (s, i) -> named_struct('id', concat(conv_id, '-', turn, '-', i),"
            " 'snippet', named_struct('totalReplyCount', i, 'topLevelComment', named_struct('snippet',"
            " named_struct('textDisplay', trim(s), 'textOriginal', concat('part ', i),"
            " 'likeCount', case when i % 4 = 3 then 'many' else cast(length(s) as string) end,"
            " 'authorDisplayName', role, 'publishedAt', '2024-01-02T03:04:05Z')))))"
        )
        return self.raw("conversations").selectExpr(
            "concat('v', conv_id, '-', turn) as item_id", "'at_discovery' as snapshot_kind", "'ok' as state",
            f"to_json({doc}) as payload",
        )

    @cached_property
    def item_threads(self) -> DataFrame:
        """Per customer and capture kind a short thread, sometimes disabled or failed."""
        c = "c_custkey"
        doc = (
            f"transform(sequence(0, cast({c} % 4 as int)), i -> named_struct('id', concat({c}, '-', i),"
            " 'snippet', named_struct('totalReplyCount', 0, 'topLevelComment', named_struct('snippet',"
            f" named_struct('textDisplay', concat('comment ', i), 'likeCount', cast({c} % 50 + i as string))))))"
        )
        return self.raw("customer").selectExpr(
            f"concat('v', {c}) as item_id",
            "explode(array('at_discovery', 'pre_release')) as snapshot_kind",
            f"case {c} % 10 when 4 then 'disabled' when 5 then 'failed' else 'ok' end as state",
            f"case when {c} % 10 not in (4, 5) then to_json({doc}) end as payload",
        )

    @staticmethod
    def _title_fields(p: str) -> str:
        offers = (
            f"named_struct('link', concat('l', {p}), 'flatrate', array(named_struct('provider_id', {p} % 30,"
            f" 'provider_name', concat('n', {p} % 30), 'display_priority', {p} % 4)), 'rent',"
            f" case when {p} % 2 = 0 then array(named_struct('provider_id', 100 + {p} % 5, 'provider_name', 'r',"
            f" 'display_priority', 1), named_struct('provider_id', 0, 'provider_name', 'z', 'display_priority', 2)) end)"
        )
        providers = (
            f"case when {p} % 10 <> 0 then named_struct('results', case when {p} % 3 = 0 then map('US', {offers})"
            f" else map('US', {offers}, 'GB', {offers}) end) end"
        )
        cast = (
            f"transform(sequence(0, cast(p_size % 14 as int)), i -> named_struct('id', {p} * 100 + i, 'name',"
            " concat('a', i), 'character', concat('c', i), 'order', case when i % 6 <> 5 then i * 7 % 13 end))"
        )
        crew = (
            f"transform(sequence(0, cast(p_size % 9 as int)), i -> named_struct('id', {p} * 100 + 50 + i % 3,"
            " 'name', concat('w', i), 'job', element_at(array('Director', 'Writer', 'Foley', 'Producer'),"
            " cast(i % 4 as int) + 1), 'department', concat('dep', i)))"
        )
        return (
            f"'status', 'Planned', 'popularity', p_retailprice, 'poster_path', concat('/p', {p}, '.jpg'),"
            " 'genres', array(named_struct('id', p_size, 'name', p_type), named_struct('id', p_size + 1, 'name',"
            f" case when {p} % 2 = 0 then 'second' end)), 'production_companies', case when {p} % 5 <> 0 then"
            f" array(named_struct('id', {p} % 7, 'name', concat('co', {p} % 7), 'origin_country', 'US'),"
            f" named_struct('id', 100, 'name', p_brand, 'origin_country', cast(null as string))) end,"
            f" 'spoken_languages', case when {p} % 4 <> 0 then array(named_struct('iso_639_1', 'en', 'english_name',"
            f" 'English', 'name', 'English'), named_struct('iso_639_1', concat('l', {p} % 3), 'english_name', cast(null as string), 'name', 'other')) end,"
            f" 'production_countries', array(named_struct('iso_3166_1', concat('C', {p} % 9)),"
            " named_struct('iso_3166_1', ''), named_struct('iso_3166_1', 'ZZ')),"
            f" 'watch/providers', {providers}, 'credits', named_struct('cast', {cast}, 'crew', {crew})"
        )

    @staticmethod
    def _videos(p: str, tag: str) -> str:
        return (
            f"transform(sequence(0, cast({p} % 4 as int)), i -> named_struct('key', concat('{tag}', {p}, '-', i % 3),"
            " 'site', element_at(array('YouTube', 'youtube', 'Vimeo'), cast((i + p_size) % 3 as int) + 1),"
            " 'type', element_at(array('Trailer', 'Teaser', 'Clip', 'Trailer'), cast((i + p_size) % 4 as int) + 1),"
            " 'name', case when i % 2 = 0 then concat('Cut ', i, ' OFFICIAL Trailer') else concat('Cut ', i) end,"
            " 'published_at', concat('2024-01-0', i + 1, 'T00:00:00.000Z'), 'official', i % 2 = 0))"
        )

    @cached_property
    def _listed(self) -> DataFrame:
        """The parts in as many tasks as their documents need: a part's row is narrow, its documents are not.

        The number is given, so that it is kept: going by the bytes of the narrow rows, few tasks would be made.
        """
        part = self.raw("part")
        return part.repartition(-(-max(part.count(), 1) // TITLES), "p_partkey")

    @cached_property
    def movie_listings(self) -> DataFrame:
        """Every part listed in two regions, with details and videos as fetched."""
        p = "p_partkey"
        doc = (
            f"named_struct('title', p_name, 'release_date', case when {p} % 5 = 0 then '' else"
            f" cast({_plus('2024-02-01', f'{p} % 100')} as string) end, 'runtime', 90 + p_size,"
            f" {self._title_fields(p)})"
        )
        return self._listed.selectExpr(
            f"{p} as movie_id", "explode(array(1, 0)) as region_order", f"{p} as position",
            "'2024-06-01' as listed_release_date",
            f"case when {p} % 31 <> 0 then to_json({doc}) end as details",
            f"case when {p} % 37 <> 0 then to_json({self._videos(p, 'm')}) end as videos",
        )

    @cached_property
    def tv_listings(self) -> DataFrame:
        p = "p_partkey"
        seasons = (
            "transform(sequence(0, cast(p_size % 4 as int)), i -> named_struct('season_number', i, 'name',"
            f" concat('S', i), 'air_date', case (i + {p}) % 5 when 0 then null when 1 then '' when 2 then 'soon'"
            f" when 3 then '2023-05-05' else cast({_plus('2024-02-01', f'({p} + i) % 50')} as string) end,"
            " 'episode_count', 6 + i))"
        )
        doc = (
            f"named_struct('name', p_name, 'first_air_date', '2024-03-01', 'origin_country', case when {p} % 3 = 0"
            f" then array('KR', '') end, 'seasons', {seasons}, {self._title_fields(p)})"
        )
        per_season = (
            "transform(sequence(1, cast(p_size % 4 as int) + 1), n -> named_struct('season_number', n, 'videos',"
            f" array(named_struct('key', concat('s', {p}, '-', n), 'site', 'YouTube', 'type', 'Trailer',"
            f" 'name', concat('Season ', n), 'official', true), named_struct('key', concat('t', {p}, '-1'),"
            " 'site', 'YouTube', 'type', 'Teaser', 'name', concat('Shared ', n), 'official', false))))"
        )
        return self._listed.selectExpr(
            f"{p} as tv_id", "0 as region_order", f"{p} as position", "'2024-06-01' as listed_first_air_date",
            f"to_json({doc}) as details", f"to_json({per_season}) as season_videos",
            f"to_json({self._videos(p, 't')}) as series_videos",
        )

    @cached_property
    def transcript_attempts(self) -> DataFrame:
        """A capture attempt per document: captions, else speech, else neither."""
        d = "doc_id"
        return self.raw("documents").selectExpr(
            f"concat('v', {d}) as item_id",
            f"case when {d} % 3 = 0 then text end as caption_text",
            f"case when {d} % 2 = 0 then 'manual' else 'auto-generated' end as caption_kind",
            f"case when {d} % 3 <> 0 then 'IpBlocked: request refused by host' end as caption_error",
            f"case when {d} % 3 = 1 then text when {d} % 6 = 2 then '' end as speech_text",
            "lang as speech_language",
            "case when n_chars % 2 = 0 then 'speech' else 'music' end as speech_kind",
            f"case when {d} % 3 = 2 and {d} % 2 = 0 then ': odd' end as speech_error",
        )
