"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "lotforge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on; `conf` keys use `__` for dots.

    A small table is read by more tasks than by default, as opening a file costs little here; large
    ones are split as before.

    Capturing the Python call site of every column expression is off: it takes about a third of
    the time needed to build these plans.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.files.openCostInBytes", "1m")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    A local master has one machine only, so a temporary folder is chosen when the setting is
    absent; on a cluster the setting is required.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="lotforge-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when the query ends.

    By default they stay until the driver happens to collect the plan's objects, so a run of many
    queries fills the disks with the sum of all its shuffles.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_folder(spark), f"{label}-{uuid.uuid4().hex}")
