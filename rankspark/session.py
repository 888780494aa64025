"""Session construction and lineage cutting.

On a cluster the session comes from the caller; ``spark.checkpoint.dir`` must
then name a shared folder.  Only tests and local runs set their own folder,
and only where the setting is unset.
"""

from __future__ import annotations

import gc
import os
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.driver.memory": "16g",
    "spark.sql.files.maxPartitionBytes": "128m",
}

#: Bytes of code beyond which the JVM never compiles a method, but interprets it for every row.
JIT_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def get_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                app: str = "rankspark") -> SparkSession:
    """Local session for tests and benchmarks (a cluster passes its own)."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in LOCAL_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def compiled_projections(spark: SparkSession) -> None:
    """Projections of dozens of columns run as several compiled methods, not as one that the JVM interprets; a limit set by the caller stays."""
    if spark.conf.get(JIT_LIMIT[0]) == "65535":
        spark.conf.set(*JIT_LIMIT)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder; set a scratch one only when unset (tests)."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder (HDFS/object store) on a cluster")
    local = tempfile.mkdtemp(prefix="rankspark-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return local


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Columnar table in the shared checkpoint folder, read back: later stages prune its columns."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored = [path]
    return out


def cut_lineage(df: DataFrame) -> DataFrame:
    """A table in the shared checkpoint folder in place of what made it.

    Survives executor loss (unlike a local checkpoint) and bounds plan size
    between wide feature stages.  Parquet, and no checkpoint of rows: it is
    compressed, and narrow stages don't read the wide ones' columns.
    """
    return materialize(df, "cut")


def joined_up(tables: list[DataFrame]) -> DataFrame:
    """Stored tables of equal columns, read as one."""
    paths = [p for t in tables for p in t._stored]
    out = tables[0].sparkSession.read.schema(tables[0].schema).parquet(*paths)
    out._stored = paths
    return out


def drop_stored(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        drop_paths(df.sparkSession, df._stored)


def drop_paths(spark: SparkSession, paths: list[str]) -> None:
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Spark deletes the files of finished shuffles when the driver's JVM collects their handles: ask it to."""
    for _ in range(2):  # Python's handles go first, then those of the JVM that they held
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)
