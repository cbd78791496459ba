"""Bounded samples of labelled rows, and sums of vectors over all rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crestline.operators.ordering import top_n

STEPS = 1 << 30


def class_counts(labelled: DataFrame, label: str) -> dict:
    """Rows per label; labels are classes, so their number is bounded."""
    return {r[0]: r[1] for r in labelled.groupBy(label).count().collect() if r[0] is not None}


def bounded_sample(labelled: DataFrame, label: str, counts: dict, most: dict, *key: str) -> DataFrame:
    """About ``most[label]`` rows of each label, chosen by a hash of ``key``: the same ones on every run, at any layout."""
    place = F.pmod(F.xxhash64(*key, F.lit("sample")), F.lit(STEPS))
    share = F.lit(0)
    for value, n in counts.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(min(STEPS, -(-STEPS * most[value] // n)))).otherwise(share)
    return labelled.where(place < share)


def first_rows(labelled: DataFrame, label: str, counts: dict, most: int, *key: str) -> DataFrame:
    """At most ``most`` rows of each label: the first ones by a hash of ``key``, the same on every run and at any layout.

    Twice as many are picked out by the hash before the first are taken; a row that stands many times may fill
    them, but never exceeds them.
    """
    near = bounded_sample(labelled, label, counts, dict.fromkeys(counts, 2 * most), *key)
    return top_n(near, [label], [F.xxhash64(*key), *[F.col(k) for k in key]], most).drop("_rn")


def summed(vectors: DataFrame, size: int, tasks: int = 64) -> np.ndarray:
    """Sum of int64 vectors (binary column ``v``), one per task: added up in ``tasks`` tasks as they stream, then here."""

    def add(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            for v in batch.column(0):
                total += np.frombuffer(v.as_py(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["v"])

    parts = vectors.repartition(tasks).mapInArrow(add, "v binary").collect()
    return np.sum([np.frombuffer(r[0], np.int64) for r in parts], axis=0) if parts else np.zeros(size, np.int64)
