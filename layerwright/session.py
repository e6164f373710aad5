"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the operators are designed for.  Anything the caller passes wins.
# - UTC: timestamps here carry no zone, so no conversion may creep in.
# - rebalance + skew join: AQE splits hot partitions and merges tiny ones.  The
#   skew threshold is well below Spark's 256m: compressed shuffle bytes grow
#   several-fold in a sort, and one key may hold a third of all rows.
# - parallelismFirst off: on a large cluster, target the advisory size rather
#   than one sliver per core.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "layerwright", master: str | None = None, conf: dict | None = None) -> SparkSession:
    """A session with the engine's settings; on a cluster leave `master` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_engine_settings(spark: SparkSession) -> SparkSession:
    """Give a session made elsewhere the engine's adaptive settings, where it names none itself."""
    own = spark.sparkContext.getConf()
    for key, value in ENGINE_CONF.items():
        if key.startswith("spark.sql.adaptive.skewJoin") and not own.contains(key):
            spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Read from `spark.checkpoint.dir`.  Only a local session that names none
    gets one made for it: on a cluster a machine-local folder would lose data.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="layerwright-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run under the shared root (never reused, never cleared)."""
    return f"{shared_root(spark)}/layerwright/{label}-{uuid.uuid4().hex[:12]}"
