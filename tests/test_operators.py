import random
import statistics

import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crestline.operators.asof import next_event
from crestline.operators.medians import exact_median
from crestline.operators.ordering import SLICES, average_ranks, group_ordinal, latest, spearman, squashed, top_n
from crestline.operators.rollup import banded_rollup, size_bucket
from crestline.operators.upsert import (
    keep_old_if_empty, keep_old_if_null, missing_ids, patch, upsert,
)


def test_ordinals_of_sliced_groups(spark, rows):
    rnd = random.Random(3)
    data = [(None if rnd.random() < 0.1 else "hot" if rnd.random() < 0.6 else f"g{rnd.randrange(5)}",
             None if rnd.random() < 0.1 else rnd.randrange(40), i) for i in range(600)]
    df = spark.createDataFrame(data, "g string, at int, id int")
    want = []
    for g in {d[0] for d in data}:
        own = sorted((d for d in data if d[0] == g), key=lambda d: (d[1] is not None, d[1] or 0, d[2]))
        want += [(*d, i, len(own)) for i, d in enumerate(own, 1)]
    for step in (F.floor(F.col("at") / 10), F.col("at"), F.lit(0)):
        got = [tuple(r) for r in group_ordinal(df, ["g"], ["at", "id"], step, "n", "size").collect()]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_a_hot_group_is_in_no_single_task(spark):
    """A group with a third of all rows: no window sees more than one slice of it, and planning runs no job."""
    df = spark.range(30_000).selectExpr("if(id % 3 = 0, 0, id) as g", "id as at")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "")
    ranked = group_ordinal(df, ["g"], ["at"], F.floor(F.col("at") / 300), "n", "size")
    assert tracker.getJobIdsForGroup("plan-only") == []
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    plan = ranked._jdf.queryExecution().toString()
    assert "row_number() windowspecdefinition(_g" in plan and "_s" in plan
    assert ranked.filter("g = 0 and n <> at / 3 + 1").count() == 0


def test_bounded_ranking_is_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as v")
    plan = top_n(df, ["k"], [F.desc("v")], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert {r.v for r in latest(df, ["k"], [F.desc("v")]).collect()} == {97, 98, 99}


def test_average_ranks(spark):
    vals = [5.0, 1.0, 5.0, 3.0, 5.0, 1.0, 9.0, -1e300, 1e300]
    counts = spark.createDataFrame([(v,) for v in vals], "v double").groupBy("v").agg(F.count("*").alias("c"))
    got = {r.v: r.rk for r in average_ranks(counts, "v", "c", "rk").collect()}
    assert got == {-1e300: 1.0, 1.0: 2.5, 3.0: 4.0, 5.0: 6.0, 9.0: 8.0, 1e300: 9.0}


def test_squashed_never_falls(spark):
    vals = sorted([-1e308, -1.0, 0.0, 49.99, 50.0, 50.001, 77.0, 100.0, 1e9, 1e308, float("inf"), float("-inf")])
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(squashed(F.col("v"))).collect()]
    assert got == sorted(got) and 0 <= got[0] and got[-1] < SLICES


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.floats(0, 100)), min_size=1, max_size=60))
def test_spearman_equals_the_correlation_of_ranks(spark, pairs):
    df = spark.createDataFrame([(None if x is None else float(x), y) for x, y in pairs], "x double, y double")
    got = spearman(df, "x", "y").first().spearman
    known = pd.DataFrame([p for p in pairs if p[0] is not None], columns=["x", "y"], dtype=float)
    flat = known["x"].nunique() < 2 or known["y"].nunique() < 2
    assert (got is None) if flat else got == pytest.approx(known["x"].rank().corr(known["y"].rank()), abs=1e-9)


def test_a_median_inside_one_bucket_of_distinct_values(spark):
    """All values of one key: the largest step holds a small part of the bracket."""
    df = spark.range(1_000_001).selectExpr("'k' as k", "cast(id as double) * 1.5 as v")
    assert exact_median(df, ["k"], "v").first().median == 750_000.0


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-3, 3), st.floats(-1e6, 1e6)), min_size=1, max_size=40))
def test_median_is_exact(spark, vals):
    df = spark.createDataFrame([("k", None if v is None else float(v)) for v in vals], "k string, v double")
    got = [r[0] for r in exact_median(df, ["k"], "v").select("median").collect()]
    known = [float(v) for v in vals if v is not None]
    assert got == ([pytest.approx(statistics.median(known))] if known else [])


def test_median_with_one_dominant_value(spark):
    vals = [7.0] * 3000 + [float(i) for i in range(2000)] + [1e9]
    df = spark.createDataFrame([("k", v) for v in vals], "k string, v double")
    assert exact_median(df, ["k"], "v").first().median == statistics.median(vals)
    even = spark.range(2500).selectExpr("'k' k", "cast(id as double) v")
    assert exact_median(even, ["k"], "v").first().median == 1249.5


EDGES = (("1", 1, 1), ("2-3", 2, 3), ("4+", 4, None))


def test_rollup_counts_bands_and_keeps_empty_buckets(spark):
    df = spark.createDataFrame([(-0.05, 1), (0.05, 1), (-0.0501, 5), (0.2, 4), (0.0, 9)], "pct double, n int")
    got = {r.bucket: r for r in banded_rollup(df, "pct", "n", EDGES, 0.05, [F.sum("n").alias("total")]).collect()}
    assert (got["all"].units, got["all"].below, got["all"].within, got["all"].above) == (5, 1, 3, 1)
    assert (got["1"].units, got["1"].within, got["1"].median) == (2, 2, 0.0)
    assert (got["2-3"].units, got["2-3"].median, got["2-3"].below_share, got["2-3"].total) == (0, None, None, None)
    assert got["4+"].median == 0.0 and got["4+"].total == 18
    assert sum(got[b].units for b in ("1", "2-3", "4+")) == got["all"].units


def test_size_bucket(spark):
    got = [r[0] for r in spark.range(6).select(size_bucket(F.col("id"), EDGES)).collect()]
    assert got == [None, "1", "2-3", "2-3", "4+", "4+"]


@settings(max_examples=6, deadline=None)
@given(
    st.sets(st.tuples(st.integers(0, 3), st.integers(0, 12)), min_size=1, max_size=25),
    st.sets(st.tuples(st.integers(0, 3), st.integers(0, 12)), min_size=1, max_size=25),
    st.booleans(),
)
def test_next_event_matches_brute_force(spark, points, events, inclusive):
    day = "date_add(date'2024-01-01', d)"
    p = spark.createDataFrame(list(points), "k int, d int").selectExpr("k", f"{day} as at", "d")
    e = spark.createDataFrame(list(events), "k int, d int").selectExpr("k", f"{day} as ev", "d as what")
    got = {(r.k, r.d): r.what for r in next_event(p, e, ["k"], "at", "ev", ["what"], inclusive).collect()}
    want = {}
    for k, d in points:
        later = [x for kk, x in events if kk == k and (x >= d if inclusive else x > d)]
        want[k, d] = min(later) if later else None
    assert got == want


TARGET = [(1, "a", 10, None), (2, "b", 20, "x")]
STAGED = [(2, "B1", 21, "y", 1), (3, "c", 30, "z", 2), (2, "B2", 22, None, 3)]


def tables(spark, staged=STAGED):
    t = spark.createDataFrame(TARGET, "k int, name string, v int, note string")
    s = spark.createDataFrame(staged, "k int, name string, v int, note string, seq int")
    return t, s


def test_upsert_respects_column_lists_and_last_row(spark, rows):
    t, s = tables(spark)
    out = upsert(t, s, ["k"], ["v", "note"], ["k", "name"], seq="seq")
    assert rows(out) == [(1, "a", 10, None), (2, "b", 22, None), (3, "c", None, None)]
    assert out.columns == t.columns


def test_upsert_twice_and_in_any_order(spark, rows):
    t, s = tables(spark)
    once = upsert(t, s, ["k"], seq="seq")
    assert rows(upsert(once, s, ["k"], seq="seq")) == rows(once)
    _, shuffled = tables(spark, STAGED[::-1])
    assert rows(upsert(t, shuffled, ["k"], seq="seq")) == rows(once)


def test_patch_changes_matches_only(spark, rows):
    t, s = tables(spark)
    out = patch(t, s, ["k"], {**keep_old_if_null("note"), "v": lambda s, t: s("v") + t("v")}, seq="seq")
    assert rows(out) == [(1, "a", 10, None), (2, "b", 42, "x")]


def test_patch_keeps_old_array_when_new_is_empty(spark, rows):
    t = spark.sql("select 1 k, array('a') x union all select 2, array('b') union all select 3, array('c')")
    s = spark.sql("select 1 k, cast(array() as array<string>) x union all select 2, null union all select 3, array('z')")
    assert rows(patch(t, s, ["k"], {"x": keep_old_if_empty("x")})) == [(1, ["a"]), (2, ["b"]), (3, ["z"])]


def test_missing_ids(spark, rows):
    asked = spark.createDataFrame([("a",), ("b",), ("b",)], "id string")
    assert rows(missing_ids(asked, spark.createDataFrame([("a",)], "id string"), "id")) == [("b",)]
