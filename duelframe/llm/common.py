"""Helpers shared by the training-data operators: stage tables and readers."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from duelframe.session import checkpoint_dir


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting (as in tests) gets a folder of
    its own; on a cluster a missing setting is an error, because executors
    would not see a folder of the driver's machine.
    """
    d = checkpoint_dir(spark)
    if d:
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder shared by driver and executors")
    d = tempfile.mkdtemp(prefix="duelframe-llm-")
    spark.sparkContext.setCheckpointDir(d)
    return d


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, free_shuffles: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read of files, not a rerun
    of what made them, and the planner knows the table's real size.
    ``free_shuffles`` drops the write's shuffle files as soon as it ends; else
    they stay until the driver happens to collect garbage.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    if free_shuffles:
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if free_shuffles:
            spark.conf.unset(SHUFFLE_CLEANUP) if before is None else spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ROWS_PER_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def in_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
             schema: str | T.StructType) -> DataFrame:
    """``df.mapInArrow`` with batches of whole texts that stay small.

    Spark's own 10,000 rows a batch suit numbers; with texts a batch and its
    copies then take hundreds of MB in the JVM and in Python.  A session that
    sets another number keeps it.
    """
    conf = df.sparkSession.conf
    if conf.get(ROWS_PER_BATCH) == "10000":
        conf.set(ROWS_PER_BATCH, "1000")
    return df.mapInArrow(run, schema)


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores appended until no name in ``taken`` equals it (case aside, as Spark compares)."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name
