"""JSON documents, training-set export and the run log."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crestline.functions.scalars import preview, preview_list
from crestline.operators.rollup import ALL
from crestline.operators.upsert import upsert
from crestline.schemas import TABLES
from crestline.session import stored
from crestline.sources.manifest import Manifest

JSON_OPTIONS = {"dateFormat": "yyyy-MM-dd", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ssXXX", "ignoreNullFields": "false"}

# The site documents and what an empty one looks like.
SITE_DOCUMENTS = {
    "carousel": "[]", "excitement_decay": "{}", "excitement_examples": '{"examples":[]}',
    "views_timeseries": '{"movies":[]}', "engagement_decay": "{}", "coverage": "{}",
    "mcp_examples": '{"tools":[]}',
}


def as_json(df: DataFrame, col: str = "value") -> DataFrame:
    """Every row as one JSON text, dates and timestamps in ISO form, nulls kept."""
    return df.select(F.to_json(F.struct(*df.columns), JSON_OPTIONS).alias(col))


def trimmed(df: DataFrame) -> DataFrame:
    """Preview of rows: arrays cut to five elements, ``text`` fields to 200 characters, at any depth."""
    return df.select(*[_cut(F.col(f.name), f.dataType, f.name).alias(f.name) for f in df.schema])


def _cut(c: Column, kind: T.DataType, name: str) -> Column:
    if isinstance(kind, T.ArrayType):
        return F.transform(preview_list(c), lambda x: _cut(x, kind.elementType, name))
    if isinstance(kind, T.StructType):
        parts = F.struct(*[_cut(c[f.name], f.dataType, f.name).alias(f.name) for f in kind])
        return F.when(c.isNotNull(), parts)
    if name == "text" and isinstance(kind, T.StringType):
        return preview(c)
    return c


def write_document(df: DataFrame, path: str) -> None:
    """A bounded result (a report or a top list) as JSON lines in a single file."""
    df.repartition(1).write.mode("overwrite").options(**JSON_OPTIONS).json(path)


def write_site(
    spark: SparkSession,
    out: str,
    builders: Mapping[str, Callable[[], DataFrame]],
    generated_at: datetime,
    meta: Mapping[str, str | int | None],
) -> DataFrame:
    """Write every site document plus ``meta`` into a new folder below ``out`` and switch readers to it as a whole.

    A section that fails leaves its empty document and does not stop the rest.
    Returns one row per document: name, path, error.
    """
    manifest = Manifest(spark, f"{out.rstrip('/')}/manifest")
    seen, _ = manifest.load()
    folder = f"documents/{uuid.uuid4().hex}"
    report = []
    for name, empty in SITE_DOCUMENTS.items():
        path, error = f"{out.rstrip('/')}/{folder}/{name}", None
        try:
            if name not in builders:
                raise KeyError(f"no builder for {name}")
            write_document(builders[name](), path)
        except Exception as exc:  # noqa: BLE001 - one bad section must not lose the others
            error = str(exc)[:200]
            spark.createDataFrame([(empty,)], "value string").coalesce(1).write.mode("overwrite").text(path)
        report.append((name, path, error))
    path = f"{out.rstrip('/')}/{folder}/meta"
    stamp = {"generated_at": generated_at.isoformat(), **meta}
    row = [tuple(None if v is None else str(v) for v in stamp.values())]
    write_document(spark.createDataFrame(row, ", ".join(f"{k} string" for k in stamp)), path)
    report.append(("meta", path, None))
    manifest.publish(seen + 1, {"folder": folder, "failed": [name for name, _, error in report if error]})
    return spark.createDataFrame(report, "name string, path string, error string")


def site_path(spark: SparkSession, out: str, name: str) -> str:
    """Where the current version of a site document lies."""
    _, doc = Manifest(spark, f"{out.rstrip('/')}/manifest").load()
    if doc is None:
        raise FileNotFoundError(f"no site at {out}")
    return f"{out.rstrip('/')}/{doc['folder']}/{name}"


def by_bucket(rolled: DataFrame, inner: str, **head: Column) -> DataFrame:
    """A roll-up of a handful of buckets as one nested document: the overall numbers beside ``head``, the rest under ``inner``."""
    numbers = [c for c in rolled.columns if c != "bucket"]
    whole = rolled.filter(F.col("bucket") == ALL).select(*[c.alias(k) for k, c in head.items()], *numbers)
    # one row per fixed bucket label
    parts = rolled.filter(F.col("bucket") != ALL).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("bucket", F.struct(*numbers).alias("v"))))).alias(inner)
    )
    return whole.withColumn(inner, parts.scalar())


def training_set(
    comment_sets: DataFrame, items: DataFrame, movies: DataFrame, min_comments: int = 3
) -> DataFrame:
    """Comment sets of published movie items with enough comments, ready for labelling."""
    published = items.filter(
        (F.col("content_kind") == "movie") & F.col("movie_id").isNotNull() & F.col("published_at").isNotNull()
    ).select("item_id", "movie_id", "published_at")
    return (
        comment_sets.filter(F.col("n_comments") >= min_comments)
        .join(published, "item_id")
        .join(movies.select("movie_id", "title"), "movie_id", "left")
        .select("item_id", "movie_id", "title", "published_at", "comments")
    )


def export_training_set(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").options(**JSON_OPTIONS).json(path)


class RunLog:
    """Collects one log row per phase of a run; the phase sets its counts."""

    def __init__(self, spark: SparkSession, run_id: str | None = None):
        self.spark, self.run_id, self._rows = spark, run_id or uuid.uuid4().hex, []

    @contextmanager
    def phase(self, name: str):
        """``with log.phase("stats") as ctx:`` — set ctx["items_processed"], ctx["notes"], …"""
        ctx: dict = {}
        started, errors = datetime.now(timezone.utc), 0
        try:
            yield ctx
        except Exception:
            errors = 1
            raise
        finally:
            self._rows.append(
                (self.run_id, name, started, datetime.now(timezone.utc), ctx.get("items_processed"),
                 ctx.get("quota_units_used"), errors, ctx.get("notes"))
            )

    def rows(self) -> DataFrame:
        return self.spark.createDataFrame(self._rows, TABLES["run_log"].ddl)

    def merged_into(self, log: DataFrame) -> DataFrame:
        return upsert(log, self.rows(), TABLES["run_log"].keys)


def observed(df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, Observation]:
    """``df`` that reports metrics while it is written, without a second pass."""
    watch = Observation(name)
    return df.observe(watch, *[c.alias(k) for k, c in metrics.items()]), watch


class Tally:
    """Counts of what a job writes, taken while it is written."""

    def __init__(self) -> None:
        self.counts: dict[str, int] = {}

    def hold(self, df: DataFrame, **metrics: Column) -> DataFrame:
        """``df`` stored once in the shared folder; its metrics join the counts. Missing sums count as zero."""
        watched, watch = observed(df, uuid.uuid4().hex, **metrics)
        held = stored(watched, "held")
        self.counts |= {k: v or 0 for k, v in watch.get.items()}
        return held
