"""Session construction for tests and the bench, and cutting of lineage.

Library operators never build a session: callers pass DataFrames in. ``local_session`` is
for the local entry points (tests, bench, scripts); ``materialize`` is used by operators
that read an intermediate result several times (an MLlib fit, a global numbering).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "placerank",
    scratch_dir: str | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """A local session configured the way the tests and bench expect.

    AQE is on (runtime coalescing, skew-join splitting, broadcast conversion by measured
    size); the UI is off; the session time zone is UTC. The checkpoint folder is a fresh
    scratch folder of this machine: on a cluster the caller builds the session and sets
    ``spark.checkpoint.dir`` to a shared file system.
    """
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Python call-site capture for error messages costs several py4j round trips per
        # Column function call while a plan is being built; off for tests and the bench.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("PLACERANK_DRIVER_MEMORY", "8g"))
    )
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    if "spark.checkpoint.dir" not in (extra_conf or {}):
        scratch = scratch_dir or tempfile.mkdtemp(prefix="placerank-ckpt-", dir="/tmp")
        builder = builder.config("spark.checkpoint.dir", "file://" + os.path.abspath(scratch))
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the folder that driver and executors share (``spark.checkpoint.dir``; a
    scratch folder only where none is set, as in a bare local session)."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = "file://" + tempfile.mkdtemp(prefix="placerank-ckpt-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(folder)
        folder = spark.sparkContext.getCheckpointDir()
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` before it is read several times: an eager, reliable
    ``checkpoint()`` into the session's checkpoint folder (``spark.checkpoint.dir``; on a
    cluster a folder that all executors share), so a lost executor does not force the
    upstream scan, join or aggregate to run again. The context's folder is left as it is;
    only where none is set at all (a bare local session) a scratch folder is taken.

    The returned frame is the handle: with ``spark.cleaner.referenceTracking.cleanCheckpoints``
    (set by ``local_session``) its files are removed once the frame is no longer referenced.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        configured = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="placerank-ckpt-", dir="/tmp"))
    return df.checkpoint(eager=True)
