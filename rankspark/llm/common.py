"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankspark.session import ensure_checkpoint_dir

#: White space that separates words: space and U+0009 to U+000D (what ``bytes.split()`` splits on).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored = path
    return out


def discard(spark: SparkSession, tables: list[DataFrame]) -> None:
    """Delete stored tables that nothing reads any more, that is once what was made of them is stored itself."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for df in tables:
        path = hadoop.Path(df._stored)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Spark deletes the files of finished shuffles when the driver's JVM collects their handles: ask it to, and give its cleaner a moment."""
    for _ in range(2):  # Python's handles go first, then those of the JVM that they held
        gc.collect()
        time.sleep(0.3)
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.7)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What is stored meanwhile goes to the Python workers in batches of at most ``rows``, for rows of many bytes."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    usual = spark.conf.get(key)
    spark.conf.set(key, str(min(int(usual), rows) if int(usual) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, usual)


def as_bytes(col: str | Column) -> Column:
    """UTF-8 bytes of a text column, empty for null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("string"), F.lit("")).cast("binary")


def remainder(col: str | Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor`` (null ids hash as the empty text)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(divisor)
