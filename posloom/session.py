"""Session settings and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings that change plans; a cluster profile may override each of them.
PLAN_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A side found small once it is there is sent to all tasks instead of shuffled to.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_LOCAL: dict[str, tempfile.TemporaryDirectory] = {}

BROADCAST_LIMIT_KEY = "spark.posloom.broadcastBytes"
DEFAULT_BROADCAST_LIMIT = 128 * 1024 * 1024


def build_session(app: str = "posloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the plan settings; keyword names use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in PLAN_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def broadcast_limit(spark: SparkSession) -> int:
    """Largest measured size, in bytes, of a table we send to every executor."""
    return int(spark.conf.get(BROADCAST_LIMIT_KEY, str(DEFAULT_BROADCAST_LIMIT)))


def shared_dir(spark: SparkSession) -> str:
    """Folder that all executors see, for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a session without
    executors of its own (``local``, ``local[n]``) that has no such setting
    gets a temporary folder, one for the whole session, removed at its end.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.conf.get("spark.master", "")):
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    session = spark.sparkContext.applicationId
    if session not in _LOCAL:
        _LOCAL[session] = tempfile.TemporaryDirectory(prefix="posloom-", ignore_cleanup_errors=True)
    return _LOCAL[session].name
