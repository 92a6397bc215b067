"""Session settings and the shared scratch location."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "tidemark", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings every plan here assumes.

    AQE coalesces small shuffles and splits skewed join partitions, so the
    shuffle partition count can be set high on a cluster. UTC keeps zoned
    timestamps (file modification times) comparable between runs; all domain
    timestamps are zone-free.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return (
        builder.config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call sites are not recorded per column: plans here are built from many small expressions.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only in local mode, as in tests, a temporary folder is created and set for
    the session where none is configured, and removed when the program ends; on a cluster that is an error, because
    executors do not share a machine's own disk.
    """
    known = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not known:
        known = spark.sparkContext.getCheckpointDir()
    if not known and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not known:
        known = tempfile.mkdtemp(prefix="tidemark-")
        atexit.register(shutil.rmtree, known, ignore_errors=True)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(known)
    return known


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is ever overwritten."""
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_CLEANING = threading.Lock()
_INSIDE: Counter[str] = Counter()
_BEFORE: dict[str, str] = {}


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the writes inside go when each write ends.

    Otherwise they stay until the driver happens to collect its garbage, so a
    row of writes keeps the shuffles of all of them. The setting is the
    session's, so it also holds for what other threads begin meanwhile; the last
    one to leave puts the former value back.
    """
    session = spark._jsparkSession.sessionUUID()
    with _CLEANING:
        _INSIDE[session] += 1
        if _INSIDE[session] == 1:
            _BEFORE[session] = spark.conf.get(_CLEANUP, "false")
            spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _CLEANING:
            _INSIDE[session] -= 1
            if not _INSIDE[session]:
                spark.conf.set(_CLEANUP, _BEFORE.pop(session))
                del _INSIDE[session]
