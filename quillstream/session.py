"""Session construction and shared scratch locations.

Scratch tables and checkpoints always live under the folder named by
``spark.checkpoint.dir``.  On a cluster that setting points at shared
storage and we only read it; a local default is created only when the
setting is absent (tests, local runs).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.driver.memory": "16g",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # reliable checkpoints (ranked batches) are
    # removed once their DataFrame is garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app_name: str = "quillstream", **conf: str) -> SparkSession:
    """The active session, or a new one.  Without ``master`` the deployment's
    own settings (spark-submit, spark-defaults) hold and nothing local is
    assumed; with a local ``master`` the defaults for tests and small runs
    apply.  ``conf`` wins over both."""
    active = SparkSession.getActiveSession()
    if active is not None:
        ensure_checkpoint_dir(active)
        return active
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    defaults = _LOCAL_DEFAULTS if master is not None and master.startswith("local") else {}
    for k, v in {**defaults, **conf}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.  Only a local master gets a
    temporary one when it is unset; on a cluster that would be one machine's
    folder, so the setting is required."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="quillstream-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table under the shared checkpoint folder."""
    base = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    base = base.rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at ``path``, or an empty one if nothing was written yet.
    Any other fault is raised."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
