"""Quality classifier: a factorisation machine over hashed words, structure statistics and metadata.

score = sigmoid(b + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j). The pairwise term is
computed as half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2 per factor, in time linear in
the features. Words carry ``log(1 + count)`` scaled to unit length; structure
statistics come from the measures of ``quality_rules``; the only metadata read is the
``n_chars`` column, compared with the text. Fitted by AdaGrad on a bounded, stratified
sample of labelled rows, at most ``TRAIN_ROWS`` per label; the intercept is then moved
to the labels' true shares, which are counted over all training labels.
"""

from __future__ import annotations

import dataclasses
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm.common import remainder, table
from crestline.llm.quality_rules import MEASURES, measured
from crestline.llm.sampling import bounded_sample, class_counts

DIMS, FACTORS, TRAIN_ROWS, EPOCHS = 1 << 14, 6, 3000, 6
RATE, DECAY, THRESHOLD = 0.05, 1e-5, 0.7
STATS = 14


def statistics(text: str | None, n_chars: int | None) -> np.ndarray:
    """Structure of a text and its metadata, each about 0 to 1."""
    m = dict(zip(MEASURES, measured(text)))
    words, lines, chars = max(m["n_words"], 1), max(m["n_lines"], 1), max(m["word_chars"], 1)
    length = len(text or "")
    share = lambda a, b: min(a / b, 3.0)
    return np.array([
        np.log1p(m["n_words"]) / 10, share(m["n_symbols"], words), m["n_dup_lines"] / lines, m["n_repeat_words"] / words,
        m["n_upper"] / chars, share(m["n_bangs"], words), share(m["n_bars"], words), share(m["word_chars"], 10 * words),
        np.log1p(words / lines) / 7, float(m["n_words"] < 50), float(m["n_words"] == 0),
        np.log1p(max(n_chars or 0, 0)) / 12, float(n_chars is None), float(n_chars is not None and n_chars != length),
    ])


def features(text: str | None, n_chars: int | None, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values; the first ``STATS`` numbers are the statistics."""
    words = (text or "").lower().encode("utf-8", "replace").split()
    hashed = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % dims
    at, counts = np.unique(hashed, return_counts=True)
    x = np.log1p(counts)
    x = x / max(np.sqrt((x * x).sum()), 1e-12)
    return np.concatenate([np.arange(STATS), at + STATS]), np.concatenate([statistics(text, n_chars), x])


@dataclasses.dataclass
class Machine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray  # features x factors

    def raw(self, at: np.ndarray, x: np.ndarray) -> float:
        vx = self.factors[at] * x[:, None]
        total = vx.sum(axis=0)
        return float(self.bias + self.weights[at] @ x + 0.5 * ((total * total).sum() - (vx * vx).sum()))

    def score(self, at: np.ndarray, x: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.raw(at, x), -35, 35))))


def fit(samples, dims: int = DIMS, factors: int = FACTORS, epochs: int = EPOCHS, rate: float = RATE, decay: float = DECAY) -> Machine:
    """AdaGrad on the logistic loss, one sample at a time."""
    turn = np.random.default_rng(0)
    m = Machine(0.0, np.zeros(dims + STATS), turn.normal(0, 0.02, (dims + STATS, factors)))
    gw, gv, gb = np.full(dims + STATS, 1e-4), np.full((dims + STATS, factors), 1e-4), 1e-4
    for _ in range(epochs):
        for i in turn.permutation(len(samples)):
            at, x, y = samples[i]
            v = m.factors[at]
            total = (v * x[:, None]).sum(axis=0)
            err = m.score(at, x) - y
            dw = err * x + decay * m.weights[at]
            dv = err * x[:, None] * (total[None, :] - v * x[:, None]) + decay * v
            gw[at] += dw * dw
            gv[at] += dv * dv
            gb += err * err
            m.weights[at] -= rate * dw / np.sqrt(gw[at])
            m.factors[at] -= rate * dv / np.sqrt(gv[at])
            m.bias -= rate * err / np.sqrt(gb)
    return m


def _feature_batches(dims):
    def run(batches):
        for batch in batches:
            rows = [features(t.as_py(), n.as_py(), dims) for t, n in zip(batch.column(0), batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                 pa.array([r[1] for r in rows], pa.list_(pa.float64())), batch.column(2)],
                ["at", "x", "y"],
            )

    return run


def train(
    docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text",
    chars_col: str = "n_chars", dims: int = DIMS, rows: int = TRAIN_ROWS, **how,
) -> Machine | None:
    """A machine for the 0/1 column ``label`` of ``labels``; None without labelled rows. Null labels teach nothing."""
    known = labels.select(F.col(id_col).alias("key"), F.col(label).alias("y")).where("key is not null and y in (0, 1)").distinct()
    sizes = class_counts(known, "y")
    if not sizes:
        return None
    # at most rows per label, so the broadcast has that bound
    picked = F.broadcast(bounded_sample(known, "y", sizes, dict.fromkeys(sizes, rows), "key"))
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"), F.col(chars_col).cast("bigint").alias("n"))
    got = (
        texts.join(picked, "key").select("text", "n", F.col("y").cast("int").alias("y"))
        .mapInArrow(_feature_batches(dims), "at array<int>, x array<double>, y int").toArrow()
    )
    samples = sorted(
        ((a.values.to_numpy(), x.values.to_numpy(), y) for a, x, y in zip(got["at"], got["x"], got["y"].to_pylist())),
        key=lambda s: (s[2], len(s[0]), s[0].tobytes(), s[1].tobytes()),
    )
    if not samples:
        return None
    m = fit(samples, dims, **how)
    seen = sum(y for *_, y in samples) / len(samples)
    odds = lambda p: np.log(np.clip(p, 1e-3, 1 - 1e-3) / (1 - np.clip(p, 1e-3, 1 - 1e-3)))
    m.bias += odds(sizes.get(1, 0) / sum(sizes.values())) - odds(seen)
    return Machine(m.bias, m.weights.astype(np.float32), m.factors.astype(np.float32))


def classify(
    docs: DataFrame, machine: Machine | None, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars", dims: int = DIMS
) -> DataFrame:
    """``doc_id, score``, one row per input row. Null and empty texts are scored on their statistics.

    Without a machine every score is 0.5. Repeated rows and ids get a row each; a null id
    stays; columns besides the three named are not read; an empty table gives an empty one.
    """

    def run(batches):
        for batch in batches:
            if machine is None:
                scores = [0.5] * batch.num_rows
            else:
                scores = [machine.score(*features(t.as_py(), n.as_py(), dims)) for t, n in zip(batch.column(1), batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], ["doc_id", "score"])

    read = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(chars_col).cast("bigint").alias("n"))
    return read.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, score double")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    machine = train(docs, labels.where(~held_out), "quality")
    return classify(docs, machine).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )
