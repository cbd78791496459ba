"""Reading and writing the library's tables and documents."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.functions.scalars import days_before
from crestline.schemas import TABLES
from crestline.sources.daytable import DayTable
from crestline.sources.manifest import Manifest, WriteConflict

# How far back a partitioned table is ever read, in days.
COUNTER_FLOOR_DAYS = 730
COMMENT_FLOOR_DAYS = 1000


def day_table(spark: SparkSession, path: str, table: str) -> DayTable:
    spec = TABLES[table]
    return DayTable(spark, path, spec.ddl, spec.partition, spec.cluster or spec.keys[0])


def scan(
    spark: SparkSession,
    path: str,
    table: str,
    since: date | str | Column | None = None,
    until: date | str | Column | None = None,
) -> DataFrame:
    """The table at ``path`` under its declared schema, bounded on its partition column.

    The bound is on the partition column itself, so the scan opens only the
    folders of the asked days.
    """
    spec = TABLES[table]
    if not spec.partition:
        return spark.read.schema(spec.ddl).parquet(path)
    if since is None:
        raise ValueError(f"{table} is partitioned by {spec.partition}: give a lower bound")
    return day_table(spark, path, table).read(since, until)


def floor_for(table: str, as_of: date | str) -> Column:
    days = COMMENT_FLOOR_DAYS if table == "comments" else COUNTER_FLOOR_DAYS
    return days_before(as_of, days)


def save(df: DataFrame, path: str, table: str) -> None:
    """Write in the table's layout: one folder per day, rows ordered by id inside."""
    if TABLES[table].partition:
        day_table(df.sparkSession, path, table).save(df)
    else:
        df.write.mode("overwrite").parquet(path)


def query(spark: SparkSession, sql: str, views: dict[str, DataFrame], **args) -> DataFrame:
    """A parametrised SQL read over named frames: ``query(s, "... FROM {items} ... :n", {"items": df}, n=5)``.

    Frames are passed to the statement itself; no view outlives it.
    """
    return spark.sql(sql, args=args, **views)


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """Label lines ``{"item_id": ..., "excitement": ...}``; malformed lines are dropped."""
    rows = spark.read.schema("item_id string, excitement double").json(path)
    return rows.filter(F.col("item_id").isNotNull() & F.col("excitement").isNotNull())


# --- whole-table versions -----------------------------------------------------------

#: versions of a table whose files are kept
KEPT = 10


def read_current(spark: SparkSession, base: str, table: str) -> DataFrame:
    """The newest version, or an empty table."""
    _, doc = Manifest(spark, f"{base}/manifest").load()
    ddl = TABLES[table].ddl
    return spark.read.schema(ddl).parquet(f"{base}/{doc['folder']}") if doc else spark.createDataFrame([], ddl)


def write_current(df: DataFrame, base: str, keep: int = KEPT) -> int:
    """Write the next version beside the current one and switch to it; returns its number.

    The current one stays readable until then. If another writer switched meanwhile this
    one fails with ``WriteConflict``. Files of versions before the last ``keep`` are removed.
    """
    spark, base = df.sparkSession, base.rstrip("/")
    manifest = Manifest(spark, f"{base}/manifest")
    seen, _ = manifest.load()
    folder = f"data/{uuid.uuid4().hex}"
    df.write.parquet(f"{base}/{folder}")
    root = Manifest(spark, base)
    try:
        manifest.publish(seen + 1, {"folder": folder})
    except WriteConflict:
        root.fs().delete(root.at(folder), True)
        raise
    for old in manifest.versions()[:-keep]:
        _, doc = manifest.load(old)
        root.fs().delete(root.at(doc["folder"]), True)
        manifest.drop(old)
    return seen + 1
