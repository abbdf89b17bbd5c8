"""Session settings for tests and the bench, and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

Result = TypeVar("Result")


def local_session(cpus: int | str = 8, name: str = "corvane") -> SparkSession:
    """A single-JVM session; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", os.environ.get("CORVANE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as ``spark.checkpoint.dir`` names it.

    Where the setting is absent a temporary folder is used, which is right only
    for a local master; elsewhere its absence is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = context.getConf().get("spark.checkpoint.dir")
    if not folder:
        folder = context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = os.path.join(tempfile.gettempdir(), f"corvane-{context.applicationId}")
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nothing has used yet."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def side_by_side(spark: SparkSession, actions: Iterable[Callable[[], Result]]) -> list[Result]:
    """Results of a few independent actions, whose jobs share the cluster.

    The first failure is raised once all have ended.
    """
    actions = list(actions)
    with ThreadPoolExecutor(max_workers=8) as pool:
        running = [pool.submit(inheritable_thread_target(spark)(a)) for a in actions]
    return [r.result() for r in running]
