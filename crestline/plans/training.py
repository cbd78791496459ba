"""Training the linear head and gating it on the decay signature.

Ridge needs only second moments, so the feature table is read a fixed number of
times whatever the size of the penalty grid: once for the moments per fold, once
for the leave-one-out errors of every (fold, penalty), once for the
out-of-fold predictions. The driver sees matrices of features x features only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crestline.operators.medians import exact_median
from crestline.operators.ordering import group_ordinal, spearman
from crestline.operators.rollup import ALL, banded_rollup
from crestline.plans.scores import SCORE_BUCKETS, score_units
from crestline.plans.scoring import LinearHead, lexicon_rates, linear_scores, pooled_features
from crestline.schemas import TABLES
from crestline.session import pin

FOLDS = 5
ALPHAS = tuple(float(a) for a in np.logspace(-1, 4, 24))  # fixed value: penalty grid

# Acceptance thresholds.
MIN_DECLINE_SHARE = 0.55
MAX_PROXY_SHARE = 0.58


def training_table(comments: DataFrame, labels: DataFrame, groups: DataFrame, folds: int = FOLDS) -> DataFrame:
    """Features, label and fold per labelled item; a group never spans two folds."""
    return (
        pooled_features(comments)
        .join(labels.select("item_id", F.col("excitement").alias("y")), "item_id")
        .join(groups.select("item_id", "movie_id"), "item_id")
        .withColumn("fold", F.pmod(F.xxhash64("movie_id"), F.lit(folds)).cast("int"))
    )


def _matrix(pdf: pd.DataFrame) -> np.ndarray:
    return np.vstack(pdf["features"].to_numpy()).astype("float64")


def _packed(m: np.ndarray) -> bytes:
    """The upper triangle, row by row."""
    return m[np.triu_indices(len(m))].tobytes()


def _unpacked(raw: bytes) -> np.ndarray:
    v = np.frombuffer(raw)
    k = int((np.sqrt(8 * v.size + 1) - 1) / 2)
    m = np.zeros((k, k))
    m[np.triu_indices(k)] = v
    return m + np.triu(m, 1).T


#: triangles added up by one task of a level
FAN = 16


def fold_moments(table: DataFrame) -> dict[int, np.ndarray]:
    """Per fold the moment matrix of (1, features, y): one row per fold reaches the driver.

    Each task sums its own rows to one packed triangle per fold. Triangles are added ``FAN`` at a
    time, level by level, so neither a task nor the driver ever holds more than that many.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for pdf in batches:
            for fold, part in pdf.groupby("fold"):
                x = _matrix(part)
                z = np.column_stack([np.ones(len(x)), x, part["y"].to_numpy(dtype="float64")])
                sums[int(fold)] = sums.get(int(fold), 0) + z.T @ z
        at = TaskContext.get().partitionId()
        for fold, m in sums.items():
            yield pd.DataFrame({"fold": [fold], "node": [at], "v": [_packed(m)]})

    def added(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(v) for v in pdf["v"]], axis=0)
        return pd.DataFrame({"fold": pdf["fold"][:1], "node": pdf["node"][:1] // FAN, "v": [total.tobytes()]})

    schema = "fold int, node bigint, v binary"
    level = table.select("fold", "features", "y").mapInPandas(partial, schema)
    nodes = table.rdd.getNumPartitions()
    while nodes > 1:
        level = level.groupBy("fold", F.expr(f"node div {FAN}")).applyInPandas(added, schema)
        nodes = -(-nodes // FAN)
    return {r.fold: _unpacked(bytes(r.v)) for r in level.select("fold", "v").collect()}


class Fit:
    """Ridge on standardised features from a moment matrix, for any penalty."""

    def __init__(self, moments: np.ndarray, mean: np.ndarray, scale: np.ndarray):
        n, sx, sy = moments[0, 0], moments[0, 1:-1], moments[0, -1]
        self.n, self.mean, self.scale = n, mean, scale
        self.center = (sx / n - mean) / scale  # mean of the scaled features in this fit
        self.y_mean = sy / n
        xx = moments[1:-1, 1:-1] - np.outer(sx, sx) / n
        xy = moments[1:-1, -1] - sx * sy / n
        values, self.axes = np.linalg.eigh(xx / np.outer(scale, scale))
        self.values = np.clip(values, 0, None)
        self.target = self.axes.T @ (xy / scale)

    def coef(self, alpha: float) -> np.ndarray:
        return self.axes @ (self.target / (self.values + alpha))

    def intercept(self, alpha: float) -> float:
        return float(self.y_mean - self.center @ self.coef(alpha))

    def left_out_errors(self, x: np.ndarray, y: np.ndarray, alphas: np.ndarray) -> np.ndarray:
        """Squared leave-one-out error summed over the rows, per penalty."""
        proj = ((x - self.mean) / self.scale - self.center) @ self.axes
        shrink = 1.0 / (self.values[:, None] + alphas[None, :])
        fitted = self.y_mean + proj @ (self.target[:, None] * shrink)
        leverage = 1.0 / self.n + (proj**2) @ shrink
        return (((y[:, None] - fitted) / (1.0 - leverage)) ** 2).sum(axis=0)

    def predict(self, x: np.ndarray, alpha: float) -> np.ndarray:
        return (x - self.mean) / self.scale @ self.coef(alpha) + self.intercept(alpha)


def choose_alphas(table: DataFrame, fits: dict[int, Fit]) -> dict[int, float]:
    """The penalty with the least leave-one-out error for each fit.

    Fit ``f`` leaves out fold ``f``; fit -1 uses all rows.
    """
    shared = table.sparkSession.sparkContext.broadcast(fits)  # features x features each
    grid = np.asarray(ALPHAS)

    def errors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {f: np.zeros(len(grid)) for f in shared.value}
        for pdf in batches:
            x, y, fold = _matrix(pdf), pdf["y"].to_numpy(dtype="float64"), pdf["fold"].to_numpy()
            for f, fit in shared.value.items():
                used = fold != f
                if used.any():
                    sums[f] += fit.left_out_errors(x[used], y[used], grid)
        for f, e in sums.items():
            yield pd.DataFrame({"fit": f, "i": np.arange(len(grid)), "e": e})

    totals = (
        table.select("fold", "features", "y")
        .mapInPandas(errors, "fit int, i int, e double")
        .groupBy("fit", "i")
        .agg(F.sum("e").alias("e"))
        .toPandas()  # fits x penalties numbers
        .sort_values(["fit", "e", "i"])
    )
    best = totals.groupby("fit").first()
    return {int(f): ALPHAS[int(i)] for f, i in best["i"].items()}


def train(table: DataFrame, version: str, layout: str) -> tuple[LinearHead, DataFrame]:
    """(head fitted on all rows, table rows with their out-of-fold prediction ``oof``)."""
    table = pin(table)  # read three times
    per_fold = fold_moments(table)
    total = sum(per_fold.values())
    n, sx = total[0, 0], total[0, 1:-1]
    mean = sx / n
    spread = np.sqrt(np.clip(np.diag(total)[1:-1] / n - mean**2, 0, None))
    scale = np.where(spread > 1e-12, spread, 1.0)  # a constant feature is only centred
    fits = {f: Fit(total - m, mean, scale) for f, m in per_fold.items() if len(per_fold) > 1}
    fits[-1] = Fit(total, mean, scale)
    alphas = choose_alphas(table, fits)
    shared = table.sparkSession.sparkContext.broadcast((fits, alphas))

    def predict(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models, alpha = shared.value
        for pdf in batches:
            x, fold = _matrix(pdf), pdf["fold"].to_numpy()
            oof = np.full(len(pdf), np.nan)
            for f in np.unique(fold):
                f = int(f) if int(f) in models else -1
                rows = fold == f if f != -1 else ~np.isin(fold, list(models))
                oof[rows] = np.clip(models[f].predict(x[rows], alpha[f]), 0, 100)
            yield pdf.assign(oof=oof)[["item_id", "movie_id", "fold", "y", "oof"]]

    oof = table.mapInPandas(
        predict, "item_id string, movie_id bigint, fold int, y double, oof double"
    )
    final = fits[-1]
    head = LinearHead(
        version, final.coef(alphas[-1]).tolist(), final.intercept(alphas[-1]),
        mean.tolist(), scale.tolist(), layout,
    )
    return head, oof


def fit_quality(predictions: DataFrame, y: str = "y", predicted: str = "oof") -> DataFrame:
    """MAE, RMSE, MAE of always predicting the mean, and Spearman's rank correlation."""
    rows = predictions.select(F.col(y).alias("y"), F.col(predicted).alias("p"))
    err = F.col("p") - F.col("y")
    mean = rows.agg(F.avg("y")).scalar()
    both = rows.filter(F.col("y").isNotNull() & F.col("p").isNotNull())
    return both.withColumn("_mean", mean).agg(
        F.count("*").alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.avg(F.abs(F.col("y") - F.col("_mean"))).alias("baseline_mae"),
    ).withColumn("spearman", spearman(both, "y", "p").scalar())


def gate_sequence(scored: DataFrame) -> DataFrame:
    """Scored items in publishing order, with both scores to compare.

    ``scored``: item_id, movie_id, published_at, excitement, lexicon.
    """
    rows = scored.filter(F.col("excitement").isNotNull() & F.col("published_at").isNotNull())
    hour = F.date_trunc("hour", "published_at")
    seq = group_ordinal(rows, ["movie_id"], ["published_at", "item_id"], hour, "item_ordinal", "in_movie")
    return seq.select("movie_id", "item_ordinal", "excitement", "lexicon")


def acceptance_gate(scored: DataFrame) -> DataFrame:
    """One row per check with its value and outcome (input as for ``gate_sequence``).

    Movies with at least two scored items count; the decline band is zero here.
    """
    seq = pin(gate_sequence(scored))  # two scores, one order
    student = banded_rollup(
        score_units(seq).select("delta", "n_items"), "delta", "n_items", SCORE_BUCKETS, 0.0
    )
    proxy = score_units(seq, "lexicon").agg(
        F.try_divide(F.count_if(F.col("delta") < 0), F.count("*")).alias("share")
    )

    def of(bucket: str, col: str):
        return F.max(F.when(F.col("bucket") == bucket, F.col(col)))

    facts = student.agg(
        of(ALL, "below_share").alias("share"), of(ALL, "median").alias("median"),
        of("5+", "median").alias("many"), of("2", "median").alias("two"),
    )
    worse = F.coalesce(F.col("many") < F.col("two"), F.lit(True))  # passes when a bucket is empty

    def check(name: str, value: Column, passed: Column) -> Column:
        return F.struct(F.lit(name).alias("check"), value.alias("value"), passed.alias("passed"))

    share, median = F.col("share"), F.col("median")
    main = facts.select(
        F.inline(
            F.array(
                check("decline_rate", share, share >= MIN_DECLINE_SHARE),
                check("median_delta", median, median < 0),
                check("dose_response", F.col("many") - F.col("two"), worse),
            )
        )
    )
    blind = proxy.select(F.inline(F.array(check("proxy_blind", share, share < MAX_PROXY_SHARE))))
    return main.unionByName(blind)


def decline_summary(seq: DataFrame, value: str) -> DataFrame:
    """Share declining, median change and mean slope of a score along the sequence."""
    units = pin(score_units(seq, value).select("delta", "slope").withColumn("bucket", F.lit(ALL)))
    sums = units.groupBy("bucket").agg(
        F.count("*").alias("movies"),
        F.count_if(F.col("delta") < 0).alias("declined"),
        F.avg("slope").alias("mean_slope"),
    )
    return sums.join(exact_median(units, ["bucket"], "delta", "median_delta"), "bucket").drop("bucket")


def trained_head(
    comments: DataFrame, labels: DataFrame, links: DataFrame, version: str, layout: str, now: Column
) -> DataFrame:
    """One row of the heads table: a head trained on the labelled items, its quality, and its gate over all items.

    ``comments`` carry embeddings; ``links`` are movie items with movie_id and published_at.
    """
    head, oof = train(training_table(comments, labels, links), version, layout)
    scored = linear_scores(pooled_features(comments), head).select("item_id", "excitement")
    rows = scored.join(lexicon_rates(comments), "item_id").join(links.select("item_id", "movie_id", "published_at"), "item_id")
    # a handful of checks
    gate = acceptance_gate(rows).agg(
        F.array_sort(F.collect_list(F.struct("check", "value", "passed"))).alias("checks"),
        F.coalesce(F.every("passed"), F.lit(False)).alias("passed"),
    )
    spark = comments.sparkSession
    fitted = spark.createDataFrame(
        [(version, [float(x) for x in head.coef], float(head.intercept), [float(x) for x in head.mean],
          [float(x) for x in head.scale], layout)],
        "version string, coef array<double>, intercept double, mean array<double>, scale array<double>, layout string",
    )
    # three frames of one row
    return (
        fitted.withColumn("trained_at", now)
        .join(F.broadcast(fit_quality(oof).withColumn("version", F.lit(version))), "version")
        .join(F.broadcast(gate.withColumn("version", F.lit(version))), "version")
        .select(*TABLES["heads"].columns)
    )
