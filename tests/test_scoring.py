import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crestline.plans import scoring, training
from crestline.schemas import TABLES

NOW = "2024-01-30 06:00:00"
DDL = "item_id string, comment_id string, rank bigint, text string, like_count bigint, embedding array<double>"


def head(dim=2, **over):
    n = dim + 3
    base = dict(version="h", coef=[1.0] * n, intercept=0.0, mean=[0.0] * n, scale=[1.0] * n, layout=scoring.feature_layout(dim))
    return scoring.LinearHead(**{**base, **over})


def features(df):
    return {r.item_id: r.features for r in scoring.pooled_features(df).collect()}


def test_a_saved_head_loads_with_its_layout_checked(spark, tmp_path):
    path = str(tmp_path / "head")
    saved = head(coef=[0.5, -1.25, 3.0, 0.0, 7.0], intercept=2.5)
    for _ in range(2):  # saving again replaces it
        scoring.save_head(spark, saved, path)
    loaded = scoring.load_head(spark, path, scoring.feature_layout(2))
    assert loaded == saved
    with pytest.raises(ValueError):
        scoring.load_head(spark, path, scoring.feature_layout(3))
    scoring.save_head(spark, head(mean=[0.0]), path)
    with pytest.raises(ValueError):
        scoring.load_head(spark, path, scoring.feature_layout(2))


def test_pooling_weights_likes_and_appends_aux(spark):
    df = spark.createDataFrame(
        [("a", "1", 1, "wow!", 3, [1.0, 0.0]), ("a", "2", 2, "ok", 0, [0.0, 1.0]), ("a", "3", 3, "x", -5, [9.0, 9.0]),
         ("b", "1", 1, "x", 0, [1.0, 0.0]), ("b", "2", 2, "y", None, [0.0, 1.0]),
         ("c", "1", 1, " \n", 9, [1.0, 1.0]), ("d", "1", 1, None, 9, [1.0, 1.0])],
        DDL,
    )
    got = features(df)
    assert got["a"] == pytest.approx([1.0, 0.0, math.log1p(1.0), math.log1p(3), 1 / 3])
    # nobody liked anything: a plain mean
    assert got["b"] == pytest.approx([0.5, 0.5, 0.0, math.log1p(2), 0.0])
    assert set(got) == {"a", "b"}


def test_only_the_best_thirty_count_and_rank_zero_is_last(spark):
    data = [("a", f"{i:02d}", i, "t", 1, [1.0]) for i in range(1, 31)] + [("a", "zz", 0, "t", 1, [100.0]), ("a", "yy", None, "t", 1, [100.0])]
    assert features(spark.createDataFrame(data, DDL))["a"][0] == pytest.approx(1.0)


def test_blank_texts_inside_the_thirty_are_not_replaced(spark):
    data = [("a", f"{i:02d}", i, "" if i <= 10 else "t", 1, [1.0]) for i in range(1, 41)]
    assert features(spark.createDataFrame(data, DDL))["a"][2] == pytest.approx(math.log1p(20))


def test_head_clips_and_checks_layout(spark):
    df = spark.createDataFrame([("a", [1.0] * 5), ("b", [1000.0] * 5), ("c", [-1000.0] * 5), ("d", None)], "item_id string, features array<double>")
    h = head(coef=[2.0] * 5, intercept=50.0, mean=[0.5] * 5, scale=[2.0] * 5)
    got = {r.item_id: r.excitement for r in scoring.linear_scores(df, h).collect()}
    assert got["a"] == pytest.approx(50 + 5 * 2 * 0.25)
    assert (got["b"], got["c"], got["d"]) == (100.0, 0.0, None)
    with pytest.raises(ValueError):
        h.check("emb384+other")


def test_score_run_scores_once_per_version(spark):
    df = spark.createDataFrame(
        [("a", "1", 1, "good", 3, [1.0, 0.0]), ("b", "1", 1, " ", 0, [1.0, 0.0]), ("bad id", "1", 1, "x", 0, [1.0, 0.0])], DDL
    ).selectExpr("*", "'at_discovery' snapshot_kind", "date'2024-01-10' snapshot_date")
    empty = spark.createDataFrame([], TABLES["scores"].ddl)
    now = F.lit(NOW).cast("timestamp")
    new, merged = scoring.score_run(df, empty, head(), "2024-01-30", now, 2)
    assert [(r.item_id, r.n_comments, str(r.scored_date)) for r in new.collect()] == [("a", 1, "2024-01-30")]
    again, merged2 = scoring.score_run(df, merged, head(), "2024-01-30", now, 2)
    assert again.count() == 0 and merged2.count() == 1
    other, both = scoring.score_run(df, merged, head(version="h2"), "2024-01-30", now, 2)
    assert other.count() == 1 and both.count() == 2


def test_comment_sets_total_over_all_comments(spark):
    data = [("a", f"{i:02d}", i, "t", i, None) for i in range(1, 41)] + [("a", "none", 0, None, 5, None)]
    df = spark.createDataFrame(data, DDL).selectExpr("*", "date'2024-01-10' snapshot_date")
    r = scoring.comment_sets(df).first()
    assert (r.n_comments, r.mean_like_count, [c.rank for c in r.comments]) == (40, 20.5, list(range(1, 31)))


def closed_form(x, y, alpha):
    """Intercept left out of the penalty."""
    m, c = x.mean(0), y.mean()
    w = np.linalg.solve((x - m).T @ (x - m) + alpha * np.eye(x.shape[1]), (x - m).T @ (y - c))
    return w, c - m @ w


def best_alpha(x, y):
    def loo(alpha):
        err = 0.0
        for i in range(len(y)):
            keep = np.arange(len(y)) != i
            w, b = closed_form(x[keep], y[keep], alpha)
            err += (y[i] - x[i] @ w - b) ** 2
        return err

    return min(training.ALPHAS, key=loo)


def test_training_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 4)) * [1, 5, 0.1, 2] + [0, 3, 1, -2]
    y = x @ [3.0, -1.0, 20.0, 0.5] + 40 + rng.normal(size=60) * 4
    fold = [i % 3 for i in range(60)]
    table = spark.createDataFrame(
        [(f"i{i}", i % 7, fold[i], x[i].tolist(), float(y[i])) for i in range(60)],
        "item_id string, movie_id bigint, fold int, features array<double>, y double",
    ).repartition(4)
    model, oof = training.train(table, "v", "layout")
    mean, scale = x.mean(0), x.std(0)
    xs = (x - mean) / scale
    w, b = closed_form(xs, y, best_alpha(xs, y))
    assert model.mean == pytest.approx(mean) and model.scale == pytest.approx(scale)
    assert model.coef == pytest.approx(w) and model.intercept == pytest.approx(b)
    got = {r.item_id: r.oof for r in oof.collect()}
    for f in range(3):
        out = np.array(fold) == f
        w, b = closed_form(xs[~out], y[~out], best_alpha(xs[~out], y[~out]))
        for i in np.flatnonzero(out):
            assert got[f"i{i}"] == pytest.approx(np.clip(xs[i] @ w + b, 0, 100))


def test_training_with_a_single_fold_and_a_constant_feature(spark):
    table = spark.createDataFrame(
        [(f"i{i}", 1, 0, [float(i), 7.0], 2.0 * i) for i in range(10)],
        "item_id string, movie_id bigint, fold int, features array<double>, y double",
    )
    model, oof = training.train(table, "v", "layout")
    assert model.scale[1] == 1.0 and oof.filter("oof is null or isnan(oof)").count() == 0


def test_groups_never_span_folds(spark):
    data = [(f"i{i}", "1", 1, "t", 1, [float(i)]) for i in range(40)]
    labels = spark.createDataFrame([(f"i{i}", 50.0) for i in range(40)], "item_id string, excitement double")
    groups = spark.createDataFrame([(f"i{i}", i % 6) for i in range(40)], "item_id string, movie_id bigint")
    table = training.training_table(spark.createDataFrame(data, DDL), labels, groups)
    assert table.count() == 40
    assert table.groupBy("movie_id").agg(F.count_distinct("fold").alias("n")).filter("n > 1").count() == 0


def test_fit_quality(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (3.0, 4.0), (4.0, 4.0)], "y double, oof double")
    r = training.fit_quality(df).first()
    assert (r.n, r.mae, r.rmse, r.baseline_mae) == (4, 0.75, pytest.approx(math.sqrt(0.75)), 1.0)
    assert r.spearman == pytest.approx(np.corrcoef([1, 2, 3, 4], [2, 1, 3.5, 3.5])[0, 1])


def test_acceptance_gate(spark):
    rnd = random.Random(1)
    data = []
    for movie in range(20):
        n = 2 if movie < 10 else 5
        for o in range(n):
            data.append((f"{movie}-{o}", movie, f"2024-01-0{o + 1} 00:00:00", 50.0 - (n > 2) * 3 * o - o * 0.1 + rnd.random() * 0.01,
                         float((movie + o) % 2)))
    df = spark.createDataFrame(data, "item_id string, movie_id bigint, at string, excitement double, lexicon double")
    scored = df.withColumn("published_at", F.col("at").cast("timestamp"))
    got = {r.check: r for r in training.acceptance_gate(scored).collect()}
    assert got["decline_rate"].passed and got["median_delta"].passed and got["dose_response"].passed
    assert got["proxy_blind"].value == pytest.approx(0.25) and got["proxy_blind"].passed
    rising = scored.withColumn("excitement", 100 - F.col("excitement"))
    bad = {r.check: r.passed for r in training.acceptance_gate(rising).collect()}
    assert not bad["decline_rate"] and not bad["median_delta"] and not bad["dose_response"]
    two = {r.check: r.passed for r in training.acceptance_gate(scored.filter("movie_id < 10")).collect()}
    assert two["dose_response"]
