"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crestline.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: whether a query's shuffle files go when it ends, or only when the driver collects its garbage
RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: where the tables of ``written`` are
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def written(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, kept when executors go. Its shuffle files go at once."""
    spark = df.sparkSession
    path, before = scratch_path(spark, label), spark.conf.get(RELEASE)
    spark.conf.set(RELEASE, "true")
    try:
        df.write.parquet(path, compression=compression)
    finally:
        spark.conf.set(RELEASE, before)
    out = spark.read.schema(df.schema).parquet(path)
    _PATHS[out] = path
    return out


def unwritten(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` returned. Nothing may read them again, nor frames made of them that are not written."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(_PATHS.pop(df))
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z only. Plain ASCII texts take the byte-wise ``lower``; for them both agree."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def remainder(key: str, of: int) -> Column:
    """crc32 of the key as text, modulo ``of``: splits labelled rows into folds."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % of
