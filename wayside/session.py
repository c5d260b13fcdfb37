"""Session settings the jobs are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# AQE carries the skew story: it splits oversized shuffle partitions of joins and
# of rebalanced writes, merges tiny ones, and turns a shuffled join into a
# broadcast one only after it has measured the small side.
CLUSTER_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Over 2,000 reducers a map task reports mean sizes, but for those this often the median's.
    "spark.shuffle.accurateBlockSkewedFactor": "5",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

# Reducers a shuffle starts with. Adaptive execution merges them down to the advised
# size, but it cannot split a window's or an aggregate's, so a cluster starts high: at
# 100 TB shuffled that is 5 GB for each, which spills within an executor.
REDUCERS = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000"}

# One JVM, eight threads: small shuffles, no UI.
LOCAL_CONF = {
    "spark.sql.shuffle.partitions": "8",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "8g",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_session(app: str = "wayside", **conf: str) -> SparkSession:
    """Session on whatever master spark-submit names."""
    builder = SparkSession.builder.appName(app)
    for key, value in {**CLUSTER_CONF, **REDUCERS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = 8, app: str = "wayside", **conf: str) -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**CLUSTER_CONF, **LOCAL_CONF, **conf}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session
