import pytest
from pyspark.sql import functions as F

from crestline.functions import scalars as fn
from crestline.functions.lexicon import hype_points


def values(spark, expr, inputs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, v string")
    return [r.o for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


@pytest.mark.parametrize(
    "text, seconds",
    [("PT2M30S", 150), ("PT1H5M10S", 3910), ("PT45S", 45), ("PT2H", 7200), ("PT", 0),
     (None, None), ("", None), ("2:30", None), ("PTabc", None), ("P1DT5S", None), ("PT5S2M", None)],
)
def test_duration(spark, text, seconds):
    assert values(spark, fn.duration_seconds, [text]) == [seconds]


def test_text_counts(spark):
    texts = ["hello world hello", None, "", " a b c\n", "   "]
    assert values(spark, fn.word_count, texts) == [3, None, None, 3, 0]
    assert values(spark, fn.char_count, texts) == [17, None, None, 7, 3]


def test_safe_parsing(spark):
    assert values(spark, fn.safe_int, ["12", "n/a", None, ""]) == [12, None, None, None]
    parsed = values(spark, fn.iso_timestamp, ["2024-01-02T03:04:05Z", "", "soon", None, "2024", "2024-01", "03:04"])
    assert [p and p.strftime("%H:%M:%S") for p in parsed][1:] == [None] * 6 and parsed[0]
    assert [str(d) for d in values(spark, fn.iso_date, ["2024-02-30", "2024-02-29", "", "x"])] == [
        "None", "2024-02-29", "None", "None",
    ]


def test_short_error(spark):
    got = values(spark, fn.short_error, ["IpBlocked: long text", "plain", ": odd", None])
    assert got == ["IpBlocked", "plain", ": odd", "None"]


def test_video_filter_and_class(spark):
    df = spark.createDataFrame(
        [("YouTube", "Trailer", "Avatar 3 | Official Trailer (HD)"), ("youtube", "Teaser", "x"),
         ("Vimeo", "Trailer", "x"), ("YouTube", "Clip", "x"), (None, "Trailer", None), ("YouTube", None, "x")],
        "site string, type string, name string",
    )
    got = df.select(
        fn.is_tracked_video(F.col("site"), F.col("type")), fn.video_class(F.col("name"), F.col("type"))
    ).collect()
    assert [r[0] for r in got] == [True, True, False, False, False, False]
    assert [r[1] for r in got][:2] == ["Official Trailer", "Teaser"]


def test_country_rules(spark):
    df = spark.sql(
        "select * from values (array('US', 'GB'), array(named_struct('iso_3166_1', 'FR'))),"
        " (cast(null as array<string>), array(named_struct('iso_3166_1', 'US'), named_struct('iso_3166_1', 'FR'))),"
        " (cast(array() as array<string>), array(named_struct('iso_3166_1', 'US'))), (array('', 'KR'), null),"
        " (null, null) t(o, p)"
    )
    got = [r[0] for r in df.select(fn.origin_countries(F.col("o"), F.col("p"))).collect()]
    assert got == [["US", "GB"], ["US", "FR"], [], ["KR"], []]
    known = [r[0] for r in df.select(fn.or_unknown(F.col("o"))).collect()]
    assert known == [["US", "GB"], ["UNKNOWN"], ["UNKNOWN"], ["", "KR"], ["UNKNOWN"]]


def test_thumbnail_preference(spark):
    ddl = ", ".join(f"{k}:struct<url:string>" for k in ("maxres", "standard", "high", "medium", "`default`"))
    df = spark.createDataFrame(
        [((("a",), ("b",), ("c",), ("d",), ("e",)),), ((None, None, None, ("d",), ("e",)),),
         ((("",), None, ("c",), None, None),), (None,)],
        f"t struct<{ddl}>",
    )
    assert [r[0] for r in df.select(fn.pick_thumbnail("t")).collect()] == ["a", "d", "c", None]


def test_image_url_and_preview(spark):
    assert values(spark, fn.image_url, ["/a.jpg", "", None]) == [
        "https://image.tmdb.org/t/p/w500/a.jpg", None, None,
    ]
    assert values(spark, lambda c: fn.preview(c, 3), ["abcd", "abc", None]) == ["abc…", "abc", None]


def test_jaccard(spark):
    df = spark.createDataFrame(
        [("Don't stop, NOW", "don't now"), ("", ""), ("...", "a"), ("Élan vital", "élan")], "a string, b string"
    )
    sets = [F.array_distinct(fn.tokens(F.col(c))) for c in "ab"]
    got = [r[0] for r in df.select(fn.jaccard(*sets)).collect()]
    assert got == [pytest.approx(2 / 3), 1.0, 0.0, 0.5]


def test_window_starts(spark):
    df = spark.createDataFrame([(5,), (6,), (20,), (21,), (None,)], "d bigint")
    got = [r[0] for r in df.select(fn.window_starts(F.col("d"))).collect()]
    assert got == [[], [0], [0], [0, 15], []]


def test_unit_vector(spark):
    df = spark.sql("select array(3f, 4f) v union all select array(0f, 0f)")
    assert [r[0] for r in df.select(fn.unit_vector(F.col("v"))).collect()] == [[0.6, 0.8], [0.0, 0.0]]


def test_hype_points(spark):
    texts = ["INSANE can't wait!! 🔥", "it is a film", None, "hyped", "ÉPIC epics", "❤️", "ABCÉ abc WOW_ WOW"]
    # two '!', INSANE shouted, insane and can't wait, one emoji
    assert values(spark, hype_points, texts) == [2 + 1 + 4 + 1, 0, 0, 2, 0, 2, 1]


def test_safe_id(spark):
    assert values(spark, fn.is_safe_id, ["a-B_9", "a b", ""]) == [True, False, False]
