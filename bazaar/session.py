"""Spark session defaults for the marts.

The marts never depend on a session setting for their *results*; these
settings only shape the physical plan (AQE, split size).  What a cluster, a
spark-submit or the user has set stays as it is: only gaps are filled.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Set only where the session has no value of its own.
PLAN_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def build_session(master: str | None = None, app: str = "bazaar",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the plan defaults.

    ``master`` is only for local runs and tests; on a cluster leave it None
    so spark-submit decides.  Values given here as arguments are set in any
    case, the defaults only where nothing is set yet.
    """
    found = SparkSession.getActiveSession()
    b = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        b = b.master(master)
    given = dict(extra or {})
    if shuffle_partitions:
        given["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in given.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    gaps = dict(PLAN_DEFAULTS)
    if master and master.startswith("local"):
        # Local runs: shuffle partitions = cores already; merging them would
        # leave cores idle in CPU-bound stages on small inputs.  (A
        # cluster keeps its own coalescing settings.)
        gaps["spark.sql.adaptive.coalescePartitions.enabled"] = "false"
    own = spark._jsparkSession.sessionState().conf()
    for k, v in gaps.items():
        if not own.contains(k) and not spark.sparkContext.getConf().contains(k):
            spark.conf.set(k, v)
    if found is None:
        spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and job state.

    Reads ``spark.checkpoint.dir`` from the session.  Only a local session
    (tests, local runs) with no setting gets a fresh scratch folder; on a
    cluster an unset folder is an error.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or _BASE.get(sc.applicationId)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster "
                             "(a machine-local folder would not survive executor loss)")
        d = tempfile.mkdtemp(prefix="bazaar-ckpt-")
    if _BASE.get(sc.applicationId) != d:
        # spark.checkpoint.dir is a static setting; the context's folder for
        # DataFrame.checkpoint() can still be registered at runtime.
        sc.setCheckpointDir(d)
        _BASE[sc.applicationId] = d
    return d


_BASE: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder (never machine-local
    on a cluster, because the base comes from the session)."""
    return os.path.join(checkpoint_dir(spark), name)
