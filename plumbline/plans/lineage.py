"""Cutting lineage through the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_clearing: set[str] = set()

#: Spark's switch that removes an execution's shuffle files as soon as it has ended.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use ``spark.checkpoint.dir`` of the session; set a folder only where none is named (tests)."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="plumbline-checkpoint-"))


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there: reused results survive lost executors. The shuffle files behind it, which nothing reads again, go at once."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        return df.select("*").checkpoint(eager=True)
    finally:
        spark.conf.unset(_SHUFFLES_GO) if before is None else spark.conf.set(_SHUFFLES_GO, before)


def release(spark: SparkSession) -> None:
    """Let the driver collect its garbage, upon which Spark's cleaner removes what nothing refers to any more, such as checkpoints (where ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set) and broadcasts."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def saved(df: DataFrame) -> DataFrame:
    """Write ``df`` as a compressed table in the shared checkpoint folder and read it from there; for wide rows that are read several times.

    Unlike checkpoints, the tables aren't removed by Spark's cleaner; they go with ``forget``, with ``clear`` or when the driver ends.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if spark.sparkContext.applicationId not in _clearing:  # what this application wrote goes when the driver ends
        _clearing.add(spark.sparkContext.applicationId)
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark))
        hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Remove tables that ``saved`` wrote and nothing reads any more."""
    for df in tables:
        for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Remove the tables that ``saved`` wrote in this application; results that still read them can't be used any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _folder(spark: SparkSession) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/plumbline-tables"
