"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Of each session that is storing checkpoints: how many at the moment, and its setting before the first.
_STORING: dict[str, tuple[int, str | None]] = {}
_STORING_LOCK = threading.Lock()


def build_session(app_name: str = "cohortlens", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC time; cluster settings win."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session, where driver and executors are one process, falls
    back to a temporary folder.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or context.getConf().get(CHECKPOINT_CONF)
    current = context.getCheckpointDir()
    if not named and not current:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
        named = tempfile.mkdtemp(prefix="cohortlens-")
    if current is None:
        context.setCheckpointDir(named)
    return named or current


@contextmanager
def _shuffle_files_dropped(spark: SparkSession) -> Iterator[None]:
    """The setting is on while any thread stores a checkpoint, and afterwards as it was before the first of them."""
    session = spark._jsparkSession.sessionUUID()
    with _STORING_LOCK:
        running, before = _STORING.get(session) or (0, spark.conf.get(SHUFFLE_CLEANUP_CONF, None))
        spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
        _STORING[session] = running + 1, before
    try:
        yield
    finally:
        with _STORING_LOCK:
            running, before = _STORING.pop(session)
            if running > 1:
                _STORING[session] = running - 1, before
            elif before is None:
                spark.conf.unset(SHUFFLE_CLEANUP_CONF)
            else:
                spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder; survives the loss of executors.

    The shuffle files behind it have no reader left, so they go at once and not
    when the driver next collects its garbage. Threads may store at the same time.
    """
    shared_dir(df.sparkSession)
    with _shuffle_files_dropped(df.sparkSession):
        # a new frame, whose execution sees the setting
        return df.select("*").checkpoint(eager=True)


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder for an intermediate table."""
    return f"{shared_dir(spark).rstrip('/')}/staging/{name}-{uuid.uuid4().hex}"
