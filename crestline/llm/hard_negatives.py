"""Hard negatives by segment summaries: bounds on scores first, exact scores where bounds leave a choice.

Vectors are cut into segments at several levels, coarse to fine. Of each segment its mean
and its deviation (the norm of what the mean leaves over) are stored beside the vector.
For two vectors, the sum over segments of ``length * mean * mean`` plus or minus
``deviation * deviation`` bounds their inner product. Rows whose bounds miss what an anchor
still looks for are dropped level by level, the rest are scored exactly.

Anchors are a query set against all rows. They go out in blocks of at most ``ANCHORS``;
each task streams its part of the rows past a block and keeps, for every window of
scores wanted, the first k rows so far. The worst kept one is the window's bound from then
on. A block's first k of all tasks are merged by a shuffle on the window. Positives are
one open window per anchor; each positive then opens a window for its negatives.

The driver holds one block of anchors and its positives at a time, whatever the table's
size. Every step reads the written summaries, so a lost executor repeats tasks only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crestline.llm.common import table, written

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
#: negative scores reach from this to that share of the positive's, in hundredths
LOW, HIGH = 30, 90
LEVELS = (4, 16)
ANCHORS = 8192
CHUNK = 512
#: below this share of pairs left, they are gathered one by one instead of multiplied as blocks
SPARSE = 1 / 16
#: integers up to here are exact in a double
EXACT = 1 << 53
#: no score is further from zero
ANY = (1 << 63) - 1


def segments(x: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean and deviation of each of ``level`` segments of every row, and the segments' lengths; segments differ by one at most."""
    edges = np.linspace(0, x.shape[1], min(level, max(x.shape[1], 1)) + 1).astype(int)
    lengths = np.diff(edges)
    if not x.shape[1]:
        return np.zeros((len(x), 1)), np.zeros((len(x), 1)), np.zeros(1)
    mean = np.add.reduceat(x, edges[:-1], axis=1) / lengths
    rest = x - np.repeat(mean, lengths, axis=1)
    return mean, np.sqrt(np.add.reduceat(rest * rest, edges[:-1], axis=1)), lengths.astype(float)


def summaries(x: np.ndarray, levels: Sequence[int]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level, means weighted by the root of their segment's length, and deviations: bounds become plain products."""
    out = []
    for level in levels:
        mean, deviation, lengths = segments(x, level)
        out.append((mean * np.sqrt(lengths), deviation))
    return out


def _prepared(dims, levels, scale):
    """(vec_id, label, embedding) to (at, vec_id, label, vec, sums), without the rows that take no part."""

    def run(batches):
        place = TaskContext.get().partitionId() << 33
        for batch in batches:
            vectors = batch.column(2)
            size = vectors.value_lengths().to_numpy()
            x = np.zeros((len(batch), dims))
            values = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)
            x[np.arange(dims) < size[:, None]] = values
            x = np.floor(x * scale)
            parts = [np.concatenate(pair, axis=1) for pair in summaries(x, levels)]
            sums = np.concatenate(parts, axis=1) if parts else np.zeros((len(x), 0))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(place, place + len(batch))), batch.column(0), batch.column(1),
                    pa.array([r.tobytes() for r in x], pa.binary()), pa.array([r.tobytes() for r in sums], pa.binary()),
                ],
                ["at", "vec_id", "label", "vec", "sums"],
            )
            place += len(batch)

    return run


def _matrix(column, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), float).reshape(len(column), dims)


class Block:
    """Rows as matrices: vectors, their summaries by level, ids and labels."""

    def __init__(self, rows: pa.Table | pa.RecordBatch, dims: int, levels: Sequence[int]):
        self.at = rows.column("at").to_numpy()
        ids = rows.column("vec_id")
        # null ids come last among equal scores
        self.unnamed = np.array(ids.is_null())
        self.id = ids.fill_null(0).to_numpy()
        self.label = rows.column("label").to_numpy()
        self.x = _matrix(rows.column("vec"), dims)
        widths = [2 * min(level, max(dims, 1)) for level in levels]
        sums = _matrix(rows.column("sums"), sum(widths))
        self.sums = []
        for part in np.split(sums, np.cumsum(widths)[:-1], axis=1) if levels else []:
            half = part.shape[1] // 2
            self.sums.append((part[:, :half], part[:, half:]))
        norms = (self.x * self.x).sum(1)
        self.exact = float(norms.max(initial=0)) < EXACT / 100

    def part(self, rows: np.ndarray) -> Block:
        new = object.__new__(Block)
        new.at, new.id, new.unnamed, new.label, new.x = (v[rows] for v in (self.at, self.id, self.unnamed, self.label, self.x))
        new.sums = [(m[rows], d[rows]) for m, d in self.sums]
        new.exact = self.exact
        return new


def narrowed(rows: Block, anchors: Block, alive: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, score) of the pairs in ``alive`` whose score can lie in the anchor's ``low`` to ``high``.

    Levels are tried coarse to fine. Bounds get a margin for rounding, so no pair inside is lost.
    """
    pairs = None
    slack = 1e-9 * (1 + np.sqrt((rows.x**2).sum(1).max(initial=0) * (anchors.x**2).sum(1).max(initial=0)))

    def product(a, b):
        return np.einsum("ij,ij->i", a[pairs[0]], b[pairs[1]])

    for (m, d), (am, ad) in zip(rows.sums, anchors.sums):
        if pairs is None:
            middle, spread = m @ am.T, d @ ad.T
            alive = alive & (middle + spread >= low - slack) & (middle - spread <= high + slack)
            if alive.mean() < SPARSE:
                pairs = np.nonzero(alive)
        else:
            middle, spread = product(m, am), product(d, ad)
            keep = (middle + spread >= low[pairs[1]] - slack) & (middle - spread <= high[pairs[1]] + slack)
            pairs = pairs[0][keep], pairs[1][keep]
    if not (rows.exact and anchors.exact):  # whole numbers of any size
        pairs = pairs or np.nonzero(alive)
        a, b = rows.x.tolist(), anchors.x.tolist()
        # a score that does not fit into a long raises OverflowError
        score = np.array([sum(int(p) * int(q) for p, q in zip(a[i], b[j])) for i, j in zip(*pairs)], np.int64)
    elif pairs is None:
        scores = rows.x @ anchors.x.T
        pairs = np.nonzero(alive & (scores >= low) & (scores <= high))
        score = scores[pairs].astype(np.int64)
    else:
        score = product(rows.x, anchors.x).astype(np.int64)
    return pairs[0], pairs[1], score


def _first(order: tuple[np.ndarray, ...], window: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first ``k`` of each window; the last key of ``order`` counts most."""
    by = np.lexsort((*order, window))
    sorted_ = window[by]
    start = np.searchsorted(sorted_, sorted_, "left")
    return by[np.arange(len(by)) - start < k]


def _search(anchors: Block, windows, k: int, same: bool, dims, levels):
    """Streams rows past ``anchors``: the first ``k`` rows of each window of scores, in this task's part.

    ``windows``: broadcast (anchor index ascending, lowest, highest score) arrays.
    """

    def run(batches):
        block, (owner, floor, cap) = anchors.value, windows.value
        n = len(owner)
        best = {c: np.zeros(0, t) for c, t in (("w", np.int64), ("score", np.int64), ("id", np.int64), ("un", bool), ("at", np.int64))}
        kth = floor.copy()
        size = 64
        for batch in batches:
            rows_all = Block(batch, dims, levels)
            start = 0
            while start < len(rows_all.at):
                rows = rows_all.part(np.arange(start, min(start + size, len(rows_all.at))))
                start, size = start + size, min(2 * size, CHUNK)
                least = np.full(len(block.at), np.inf)
                most = np.full(len(block.at), -np.inf)
                np.minimum.at(least, owner, kth.astype(float))
                np.maximum.at(most, owner, cap.astype(float))
                alive = (rows.label[:, None] == block.label) == same
                alive &= rows.at[:, None] != block.at
                i, j, score = narrowed(rows, block, alive, least, most)
                # an anchor's windows are neighbours
                first, last = np.searchsorted(owner, j, "left"), np.searchsorted(owner, j, "right")
                times = last - first
                pair = np.repeat(np.arange(len(j)), times)
                w = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first, times)
                ok = (score[pair] >= kth[w]) & (score[pair] <= cap[w])
                pair, w = pair[ok], w[ok]
                if not len(w):
                    continue
                best = {
                    c: np.concatenate([best[c], v])
                    for c, v in (("w", w), ("score", score[pair]), ("id", rows.id[i[pair]]), ("un", rows.unnamed[i[pair]]), ("at", rows.at[i[pair]]))
                }
                keep = _first((best["at"], best["id"], best["un"], -best["score"]), best["w"], k)
                best = {c: v[keep] for c, v in best.items()}
                held = np.bincount(best["w"], minlength=n)
                full = np.flatnonzero(held >= k)
                ends = np.cumsum(held)[full] - 1  # best is sorted by window, then order
                kth[full] = best["score"][ends]
        if len(best["w"]):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(best["w"]), pa.array(best["score"]),
                    pa.array(best["id"], mask=best["un"]), pa.array(best["at"]),
                ],
                ["w", "score", "vec_id", "at"],
            )

    return run


def in_windows(rows: DataFrame, anchors, windows, k: int, same: bool, dims: int, levels: Sequence[int]) -> DataFrame:
    """``w, score, vec_id, at, rank``: the first ``k`` rows of every window, over all of ``rows``."""
    sc = rows.sparkSession.sparkContext
    found = written(
        rows.mapInArrow(_search(sc.broadcast(anchors), sc.broadcast(windows), k, same, dims, levels), "w bigint, score bigint, vec_id bigint, at bigint"),
        "hard-negative-parts",
    )
    first = Window.partitionBy("w").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "at")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
    every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    scale: int = SCALE, levels: Sequence[int] = LEVELS, block: int = ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Anchors are the rows whose id is divisible by ``every``. Rows with a null label, a null
    vector or a component that is null or not finite take no part; a shorter vector counts as
    ending in zeros. Scores are inner products of the components' ``floor(scale * x)``, whole numbers that must
    fit into a long. A row is its own row: repeated ids and repeated rows are partners of each
    other like any two rows, and each anchor row gets its own answer. Rows without an id are
    never anchors, and the last of equal scores. Equal scores are ordered by id, then by place in the table. An empty
    table, or one without anchors, gives an empty result; other columns are not read.
    """
    spark = vectors.sparkSession
    used = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), F.col(vector_col).cast("array<double>").alias("v")
    ).where(
        "label IS NOT NULL AND v IS NOT NULL AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    )
    dims = used.agg(F.max(F.size("v"))).first()[0] or 0
    rows = written(used.mapInArrow(_prepared(dims, levels, scale), "at bigint, vec_id bigint, label bigint, vec binary, sums binary"), "segment-summaries")
    chosen = rows.where(F.col("vec_id") % every == 0)
    # hashing deals unevenly: half as many blocks again keep each below its bound
    blocks = -(-chosen.count() // block)
    blocks += blocks // 2
    out = []
    for b in range(blocks):
        here = chosen.where(F.pmod(F.xxhash64("at"), F.lit(blocks)) == b).orderBy("at")
        anchors = Block(here.toArrow().combine_chunks(), dims, levels)
        n = len(anchors.at)
        everything = np.arange(n), np.full(n, -ANY), np.full(n, ANY)
        found = in_windows(rows, anchors, everything, positives, True, dims, levels).orderBy("w", "rank").toArrow()
        if not len(found):
            continue
        owner, score = (found.column(c).to_numpy() for c in ("w", "score"))
        floor, cap = zip(*((-(-low * p // 100), high * p // 100) for p in score.tolist()))
        hits = in_windows(rows, anchors, (owner, np.array(floor), np.array(cap)), negatives, False, dims, levels)
        pairs = spark.createDataFrame(
            pa.table(
                {
                    "w": pa.array(np.arange(len(owner))), "anchor_id": pa.array(anchors.id[owner]),
                    "positive_id": found.column("vec_id"), "positive_score": pa.array(score),
                }
            )
        )
        out.append(
            hits.join(F.broadcast(pairs), "w").select(  # at most positives * block rows
                "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
            )
        )
    if not out:
        return spark.createDataFrame([], "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint")
    return reduce(DataFrame.union, out)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    seventh = F.col("vec_id") % 7 == 0
    shifted = F.when(seventh, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", shifted))


OP12_SQL = f"""
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
             CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT a, b AS positive, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= {POSITIVES}),
n AS (SELECT p.a, positive, p.score AS ps, s.b, s.score, row_number() OVER (PARTITION BY p.a, positive ORDER BY s.score DESC, s.b) AS rank
      FROM p JOIN s ON s.a = p.a AND NOT same AND {LOW} * p.score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.score)
SELECT a AS anchor_id, positive AS positive_id, CAST(rank AS INTEGER) AS rank, b AS negative_id, ps AS positive_score, score AS negative_score
FROM n WHERE rank <= {NEGATIVES}
"""
