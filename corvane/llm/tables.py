"""Reading the given tables, and small frames that several operators need."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` of a document table; rows without an id are left out,
    since no result could name them."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(
        F.col("doc_id").isNotNull()
    )


#: What a Python worker keeps from task to task: one thing at most, by its key.
_kept: dict = {}


def kept(key: tuple, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept by the worker for the next task that asks for the same ``key``."""
    if key not in _kept:
        release()
        _kept[key] = make()
    return _kept[key]


def release() -> None:
    """Gives back what the worker keeps, and memory that is free, so that operators in turn do not add up."""
    _kept.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only some C libraries have it
        pass


def schema_of(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names, which all executors reach.

    Only where it is unset and the master is local, as in tests, is it a
    temporary folder of the session.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = os.path.join(context._temp_dir, "checkpoints")
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The frame, written once to the shared folder; its lineage ends there."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def ranked(df: DataFrame, keys: list, name: str) -> DataFrame:
    """The rows with their number from 1 in the order of ``keys``, without one task seeing all rows.

    Rows are dealt out by ranges of the keys and written to the shared folder, so
    their division cannot change; each range numbers its own and starts where the
    counts of those before it end. ``keys`` should tell rows apart.
    """
    spark = df.sparkSession
    dealt = checkpointed(
        df.repartitionByRange(shuffle_partitions(spark), *keys).withColumn("range_part", F.spark_partition_id())
    )
    counts = dealt.groupBy("range_part").agg(F.count("*").alias("in_part"))
    before = counts.withColumn(
        "before", F.sum("in_part").over(Window.orderBy("range_part")) - F.col("in_part")
    )  # a row for each range
    own = F.row_number().over(Window.partitionBy("range_part").orderBy(*keys))
    return (
        dealt.withColumn(name, own)
        .join(F.broadcast(before.select("range_part", "before")), "range_part")
        .withColumn(name, F.col(name) + F.col("before"))
        .drop("range_part", "before")
    )
