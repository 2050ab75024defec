"""Session settings the engine is designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE sizes the shuffles, splits skewed joins and
# turns a join into a broadcast only when the measured side is under the limit, so
# no operator in this package carries a broadcast hint of its own.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(
    app: str = "ledgerloom", master: str | None = None, shuffle_partitions: int | None = None
) -> SparkSession:
    """Session with the engine's settings; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master).config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in CLUSTER_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Use the cluster's shared checkpoint folder; set ``fallback`` only if none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    target = named or fallback
    if not target:
        raise ValueError("no spark.checkpoint.dir is set and no fallback folder was given")
    spark.sparkContext.setCheckpointDir(target)
    return target
