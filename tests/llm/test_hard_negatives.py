import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crestline.llm.hard_negatives import Block, hard_negatives, narrowed, segments, summaries

DDL = "vec_id bigint, embedding array<float>, label int, at bigint, score double, w string, v string"


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(*r, 1, 0.5, "w", "v") for r in rows], DDL).repartition(parts)


def expected(rows, every=100, positives=5, negatives=10):
    kept = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v], label)
        for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    order = lambda r: (-r[0], r[1] is None, r[1] or 0)
    for a, (i, v, label) in enumerate(kept):
        if i is None or i % every:
            continue
        scored = [(sum(p * q for p, q in zip(v, w)), j, m == label) for b, (j, w, m) in enumerate(kept) if a != b]
        for ps, pid, _ in sorted((s for s in scored if s[2]), key=order)[:positives]:
            fit = sorted((s for s in scored if not s[2] and 30 * ps <= 100 * s[0] <= 90 * ps), key=order)
            out += [(i, pid, r, s[1], ps, s[0]) for r, s in enumerate(fit[:negatives], 1)]
    return out


def found(df, **more):
    got = hard_negatives(df, **more)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def vectors(seed, n, dims, step=None, labels=3):
    turn = random.Random(seed)
    draw = (lambda: turn.choice(step) / 256) if step else (lambda: turn.gauss(0, 0.2))
    return [(i, [draw() for _ in range(dims)], turn.randrange(labels)) for i in range(n)]


@pytest.mark.parametrize(
    ("rows", "more"),
    [
        (vectors(1, 400, 64), {}),
        (vectors(2, 300, 10), {"every": 20, "block": 4}),  # many blocks of anchors
        (vectors(3, 300, 3, step=(-1, 0, 1)), {"every": 30}),  # ties, scores of zero and below
        (vectors(4, 200, 7, step=(0, 5, 900_000)), {"every": 50, "levels": (1, 2, 7)}),
        (vectors(5, 60, 6, step=(1, 1 << 28, -(1 << 27))), {"every": 20}),  # beyond what a double holds exactly
        (vectors(6, 150, 5), {"every": 50, "levels": ()}),
    ],
)
def test_equals_brute_force(spark, rows, more):
    got = found(frame(spark, rows), **more)
    assert got == sorted(expected(rows, more.get("every", 100)), key=str) and got


def test_awkward_rows(spark):
    rows = [(i, v, i % 2) for i, v, _ in vectors(7, 120, 4, step=(0, 100, 200))]
    rows += [
        (200, None, 1), (300, [0.5, None, 0.5, 0.5], 1), (400, [float("nan")] * 4, 1), (500, [float("inf"), 0.0, 0.0, 0.0], 1),
        (600, [0.5] * 4, None), (700, [], 1), (None, [0.5] * 4, 0), (None, [0.4] * 4, 1), (800, [0.9], 1), (900, [0.3] * 4, 5),
        (0, [0.5] * 4, 0), (3, [0.5] * 4, 1), (3, [0.5] * 4, 1),
    ]
    assert found(frame(spark, rows)) == sorted(expected(rows), key=str)


def test_nothing_to_do(spark):
    assert found(frame(spark, [])) == []
    assert found(frame(spark, [(1, [0.5], 1), (2, [0.5], 2)])) == []
    assert found(frame(spark, [(0, [0.5], 1), (2, [0.5], 2)])) == []
    assert found(frame(spark, [(0, [], 1), (2, [], 2), (3, [], 1)])) == expected([(0, [], 1), (2, [], 2), (3, [], 1)])


@given(st.integers(1, 9), st.integers(1, 12), st.integers(0, 10_000))
@settings(max_examples=60, deadline=None)
def test_bounds_hold(level, dims, seed):
    x = np.floor(np.random.default_rng(seed).normal(0, 50, (6, dims)))
    ((m, d),) = summaries(x, (level,))
    assert (segments(x, level)[2] > 0).all()
    middle, spread, exact = m @ m.T, d @ d.T, x @ x.T
    assert (exact <= middle + spread + 1e-6).all() and (exact >= middle - spread - 1e-6).all()


def test_close_groups_are_settled_by_bounds():
    """Rows far from the anchor are dropped by their summaries alone."""
    turn = np.random.default_rng(5)
    near, far = turn.normal(100, 1, (50, 32)), turn.normal(-100, 1, (950, 32))
    rows, anchors = object.__new__(Block), object.__new__(Block)
    for block, x in ((rows, np.floor(np.vstack([near, far]))), (anchors, np.floor(near[:2]))):
        block.x, block.exact, block.sums = x, True, summaries(x, (4, 16))
    alive = np.ones((1000, 2), bool)
    i, j, score = narrowed(rows, anchors, alive, np.zeros(2), np.full(2, np.inf))
    assert sorted(set(i.tolist())) == list(range(50)) and len(i) == 100
    assert (score == (rows.x @ anchors.x.T)[i, j]).all()
    (m, d), (am, ad) = rows.sums[0], anchors.sums[0]
    assert ((m @ am.T + d @ ad.T) >= 0).sum() == 100
