"""Spark session helpers.

The library never builds its own session inside a job: every public
function takes the caller's ``SparkSession``.  ``local_session`` exists for
tests, the bench and ad-hoc use on one machine.  ``checkpoint_root`` reads
``spark.checkpoint.dir`` from the session (a shared folder on a cluster) and
only sets a scratch folder when none is configured, as in tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at any scale: AQE re-plans shuffles at runtime
# (coalesces small partitions, splits skewed join partitions); the UI is off
# because it is a web server.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    # Fall back from whole-stage codegen when a stage's generated method is
    # too big for the JVM to JIT-compile (8000 bytecodes); such a method would
    # otherwise run interpreted.  The wide cleaning projections hit this.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(
    master: str | None = None,
    shuffle_partitions: int = 8,
    app_name: str = "bankmart",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and the bench (``local[*]`` by default)."""
    builder = SparkSession.builder.master(master or "local[*]").appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("BANKMART_DRIVER_MEMORY", "8g")
    if extra_conf:
        conf.update(extra_conf)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, creating a scratch one if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is.  Only when it is unset on a local master (tests, one machine) a fresh
    scratch folder is made; a cluster without the setting is an error, since
    a machine-local folder would not survive the loss of that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        current = tempfile.mkdtemp(prefix="bankmart-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def staged(df: DataFrame, what: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: what several
    parts of a query read is computed once, and outlives any executor."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def ship_library(spark: SparkSession) -> None:
    """Let Python workers import this library by the path the driver uses."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])
