"""Session helpers.

The library never builds a session behind the caller's back: every operator takes
DataFrames (or a ``SparkSession``) and returns DataFrames.  ``local_session`` is for
tests, the bench and the smoke entry point only.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every run relies on: ANSI stays on (tolerant conversions use try_*),
# dates are computed in UTC so both engines of the oracle agree, AQE re-plans
# joins / coalesces partitions / splits skewed partitions at run time.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # HotSpot does not JIT-compile methods above 8000 bytes of bytecode; a fused
    # stage beyond that would run interpreted.  Above the limit Spark falls back to
    # per-operator code generation instead (recommended setting for HotSpot JVMs).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ontime") -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.driver.memory", os.environ.get("ONTIME_DRIVER_MEMORY", "16g"))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def tuned(spark: SparkSession) -> SparkSession:
    """The given session with ``BASE_CONF``'s limit on method size, unless it has one of its own: at Spark's
    default the wide stages here run as methods that HotSpot leaves to the interpreter."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(limit)) == 65535:
        spark.conf.set(limit, BASE_CONF[limit])
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).  A temporary one
    is created and registered only when none is configured and the master is local (tests);
    on a cluster executors would not see it, so that raises."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not _is_local(spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="ontime-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def _is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names storage every executor can reach;
    it is read from the session.  Only when it is unset (local runs, tests) is a
    directory of our own created and registered.
    """
    return f"{shared_root(spark)}/ontime/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable: register the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        root = shared_root(spark)
        spark.sparkContext.setCheckpointDir(root)
