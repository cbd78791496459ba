"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased; whatever is not a letter becomes one blank. Character n-grams of
one to three letters are hashed to ``DIMS`` features, weighted by ``1 + log(count)`` and
inverse document frequency, and scaled to unit length. Document frequencies come from
every training document. The classifier is fitted on a bounded, stratified sample of
training documents, at most ``TRAIN_ROWS`` per language, with follow-the-regularised-
leader and elastic-net penalties, which leaves a sparse weight matrix. A part of the
sample is held back to fit one temperature, so that scores are calibrated.
"""

from __future__ import annotations

import dataclasses
import functools
import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.llm.common import remainder, table
from crestline.llm.sampling import class_counts, first_rows, summed

DIMS, TRAIN_ROWS, EPOCHS, CALIBRATION = 1 << 15, 600, 3, 0.2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 2e-3, 1e-3
UNKNOWN = "und"


@functools.cache
def _letters() -> np.ndarray:
    return np.array([chr(i).isalpha() for i in range(sys.maxunicode + 1)])


def grams(text: str | None, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and counts of a text's n-grams; empty without letters."""
    none = np.zeros(0, np.int64)
    if not text:
        return none, none
    c = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    letter = _letters()[c]
    if not letter.any():
        return none, none
    keep = letter.copy()
    keep[0] = True
    keep[1:] |= letter[:-1]  # the first blank after a letter stays
    c = np.where(letter, c, np.uint32(32))[keep]
    bits = np.uint32(32 - (dims - 1).bit_length())
    one = c * np.uint32(2654435761)
    two = one[:-1] * np.uint32(31) + (c[1:] + np.uint32(7)) * np.uint32(2246822519)
    three = two[:-1] * np.uint32(37) + (c[2:] + np.uint32(13)) * np.uint32(3266489917)
    mixed = np.concatenate([one[letter[keep]], two, three])
    mixed ^= mixed >> np.uint32(15)
    counts = np.bincount((mixed * np.uint32(668265263)) >> bits, minlength=dims)
    at = np.flatnonzero(counts)
    return at, counts[at]


def weigh(at: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = (1 + np.log(counts)) * idf[at]
    return x / max(np.sqrt((x * x).sum()), 1e-12)


@dataclasses.dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # features x languages
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return weigh(at, counts, self.idf) @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        at, counts = grams(text, len(self.idf))
        if not len(at) or not self.languages:
            return UNKNOWN, 0.0
        p = softmax(self.logits(at, counts) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(samples, classes: int, dims: int, epochs: int, alpha: float, beta: float, l1: float, l2: float):
    """Weights and bias after ``epochs`` passes over (feature numbers, values, class)."""
    z, n = np.zeros((dims + 1, classes)), np.zeros((dims + 1, classes))

    def shrunk(rows):
        strength = np.where(np.abs(z[rows]) > l1, z[rows] - np.sign(z[rows]) * l1, 0)
        return -strength / ((beta + np.sqrt(n[rows])) / alpha + l2)

    order = np.random.default_rng(0)
    for _ in range(epochs):
        for i in order.permutation(len(samples)):
            at, x, y = samples[i]
            rows, values = np.append(at, dims), np.append(x, 1.0)  # the last row is the bias
            w = shrunk(rows)
            p = softmax(values @ w)
            p[y] -= 1
            g = values[:, None] * p[None, :]
            z[rows] += g - (np.sqrt(n[rows] + g * g) - np.sqrt(n[rows])) / alpha * w
            n[rows] += g * g
    w = shrunk(np.arange(dims + 1))
    return w[:-1], w[-1]


def calibrated(logits: np.ndarray, y: np.ndarray) -> float:
    """The temperature with the least log loss."""
    if not len(y):
        return 1.0
    tried = np.exp(np.linspace(np.log(0.02), np.log(20), 200))
    loss = [-np.log(softmax(logits / t)[np.arange(len(y)), y] + 1e-12).mean() for t in tried]
    return float(tried[int(np.argmin(loss))])


def _frequencies(dims):
    def run(batches):
        df = np.zeros(dims + 1, np.int64)
        for batch in batches:
            for text in batch.column(0):
                at, _ = grams(text.as_py(), dims)
                df[at] += 1
                df[dims] += 1
        yield pa.RecordBatch.from_arrays([pa.array([df.tobytes()], pa.binary())], ["v"])

    return run


def _features(dims):
    def run(batches):
        for batch in batches:
            pairs = [grams(t.as_py(), dims) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[0].astype(np.int32) for p in pairs], pa.list_(pa.int32())),
                 pa.array([p[1].astype(np.int32) for p in pairs], pa.list_(pa.int32())), batch.column(1)],
                ["at", "counts", "lang"],
            )

    return run


def train(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", dims: int = DIMS,
    rows: int = TRAIN_ROWS, epochs: int = EPOCHS, alpha: float = ALPHA, beta: float = BETA, l1: float = L1, l2: float = L2,
) -> Model:
    """A model of the languages named in ``lang_col``; rows with a null text or language teach nothing."""
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        "text is not null and lang is not null"
    )
    sizes = class_counts(labelled, "lang")
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(dims), np.zeros((dims, 0)), np.zeros(0))
    df = summed(labelled.select("text").mapInArrow(_frequencies(dims), "v binary"), dims + 1)
    idf = np.log((1 + df[dims]) / (1 + df[:dims])) + 1
    sample = first_rows(labelled, "lang", sizes, rows, "id", "text")
    got = sample.select("text", "lang").mapInArrow(_features(dims), "at array<int>, counts array<int>, lang string").toArrow()
    number = {name: i for i, name in enumerate(languages)}
    samples = sorted(
        (
            (a.values.to_numpy(), c.values.to_numpy(), number[y])
            for a, c, y in zip(got["at"], got["counts"], got["lang"].to_pylist()) if len(a)
        ),
        key=lambda s: (s[2], len(s[0]), s[0].tobytes(), s[1].tobytes()),
    )
    turn = np.random.default_rng(1).permutation(len(samples))
    held = int(len(samples) * CALIBRATION)
    fit = [(samples[i][0], weigh(samples[i][0], samples[i][1], idf), samples[i][2]) for i in turn[held:]]
    weights, bias = ftrl(fit, len(languages), dims, epochs, alpha, beta, l1, l2)
    model = Model(languages, idf.astype(np.float32), weights.astype(np.float32), bias.astype(np.float32))
    back = [samples[i] for i in turn[:held]]
    model.temperature = calibrated(
        np.array([model.logits(a, c) for a, c, _ in back]).reshape(len(back), len(languages)), np.array([y for *_, y in back], int)
    )
    return model


def identify(docs: DataFrame, model: Model, text_col: str = "text", into: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``docs`` with the predicted language and its probability.

    Null texts and texts without a letter are ``und`` with score 0, as is everything under a
    model without languages. Columns named like the two new ones are replaced; the rest,
    repeated rows included, pass through. An empty table gives an empty one.
    """
    carried = [c for c in docs.columns if c not in into]
    spot = carried.index(text_col)

    def run(batches):
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(spot)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                [*carried, *into],
            )

    kept = docs.select(*carried)
    schema = kept.withColumn(into[0], F.lit("")).withColumn(into[1], F.lit(0.0)).schema
    return kept.mapInArrow(run, schema)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder("doc_id", 4) == 2
    model = train(docs.where(~F.coalesce(held_out, F.lit(False))))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )
