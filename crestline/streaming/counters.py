"""Incremental ingest: counter snapshots and event counts from file streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from crestline.schemas import TABLES
from crestline.session import pin
from crestline.sources.daytable import DayTable
from crestline.sources.tables import day_table

EVENTS_DDL = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
DAILY_COUNTS = ("views", "likes", "comments")
COUNTS_DDL = "item_id string, views bigint, likes bigint, comments bigint, day date"
LEDGER_DDL = f"file string, {COUNTS_DDL}"
#: data folders a day of the ledger may have before they become one
LEDGER_FOLDERS = 16


def ingest_snapshots(
    spark: SparkSession, source: str, target: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Merge arriving snapshot files into the day table at ``target``.

    A row replaces the stored one of the same item and day; a late day rewrites
    only its own partition. Replaying a batch after a failure changes nothing.
    """
    spec = TABLES["counter_snapshots"]
    arriving = (
        spark.readStream.schema(spec.ddl)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(source)
        .withColumn("_seq", F.struct("collected_at", "view_count", "like_count", "comment_count"))
    )

    def merge(batch: DataFrame, _batch_id: int) -> None:
        # the batch is read twice (touched days, merge): fix its rows first
        day_table(batch.sparkSession, target, "counter_snapshots").merge(pin(batch), spec.keys, seq="_seq")

    return (
        arriving.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(merge)
        .start()
    )


def daily_event_counts(events: DataFrame, *by: str) -> DataFrame:
    """Events per user and day (views: every event, likes: clicks, comments: purchases), and per ``by``."""
    kind = F.col("event_type")
    return (
        events.groupBy(*by, F.to_date("ts").alias("day"), "user_id")
        .agg(
            F.count("*").alias("views"),
            F.count_if(kind == "click").alias("likes"),
            F.count_if(kind == "purchase").alias("comments"),
        )
        .select(
            *by, F.concat(F.lit("v"), F.col("user_id").cast("string")).alias("item_id"),
            *DAILY_COUNTS, "day",
        )
    )


def counts_table(spark: SparkSession, target: str) -> DayTable:
    """The day table of event counts that ``ingest_events`` keeps."""
    return DayTable(spark, f"{target}/counts", COUNTS_DDL, "day", "item_id")


def ledger_table(spark: SparkSession, target: str) -> DayTable:
    """What each source file adds to each day and item."""
    return DayTable(spark, f"{target}/ledger", LEDGER_DDL, "day", "item_id")


def once_per_file(ledger: DataFrame) -> DataFrame:
    """A file that was read again has equal rows: they count once."""
    return ledger.groupBy("file", "item_id", "day").agg(*[F.max(c).alias(c) for c in DAILY_COUNTS])


def ingest_events(
    spark: SparkSession, source: str, target: str, checkpoint: str, files_per_batch: int = 1000
) -> StreamingQuery:
    """Keep per-day event counts below ``target`` current, whatever order the files arrive in.

    A batch opens its own files only. What they add per day and item goes into a ledger
    under the file's name, and the days they touch are summed from the ledger. Nothing is ever too
    late, and a file that is read again, by a replayed batch or by a stream that starts over,
    changes nothing. Events without a time have no day and are left out.
    """
    events = (
        spark.readStream.schema(EVENTS_DDL).option("maxFilesPerTrigger", files_per_batch).parquet(source)
        .select("*", F.col("_metadata.file_path").alias("file"))
    )

    def book(batch: DataFrame, _batch_id: int) -> None:
        book_events(batch, target)

    return (
        events.writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(book)
        .start()
    )


def book_events(batch: DataFrame, target: str) -> None:
    """Enter events (with their ``file``) into the ledger and bring the counts of their days up to date."""
    spark = batch.sparkSession
    added = pin(daily_event_counts(batch.filter(F.col("ts").isNotNull()), "file"))
    # one value per calendar day
    days = [r[0] for r in added.select("day").distinct().collect()]
    if not days:
        return
    booked = ledger_table(spark, target).append(
        added, lambda rows: once_per_file(rows).select("file", "item_id", *DAILY_COUNTS, "day"), LEDGER_FOLDERS
    )
    ledger = once_per_file(ledger_table(spark, target).read(days=days, state=booked))
    counts_table(spark, target).save(
        ledger.groupBy("item_id", "day").agg(*[F.sum(c).alias(c) for c in DAILY_COUNTS])
    )
