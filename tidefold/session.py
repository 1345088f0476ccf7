"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job wants.  Shuffle partition counts are left to the
# cluster: adaptive execution coalesces small ones and splits skewed ones.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split skewed join may need one more shuffle above it; take it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Fixed when a session starts.  Call sites recorded for error messages cost several
# round trips to the JVM for every column expression.
START_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

_local_scratch: dict[str, str] = {}


def build_session(app: str = "tidefold", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RUNTIME_CONF, **START_CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session someone else created."""
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder every executor can reach.

    The cluster names the shared place in ``spark.checkpoint.dir``.  Only a
    local-mode session, whose executors live in this process, may fall back to
    a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        if context.applicationId not in _local_scratch:
            _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="tidefold-")
        base = _local_scratch[context.applicationId]
    return f"{base.rstrip('/')}/tidefold/{purpose}-{uuid.uuid4().hex}"
