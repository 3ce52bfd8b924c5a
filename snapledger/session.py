"""Session settings the operators count on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes the shuffles, splits skewed join keys and rebalanced partitions;
# times are stored and shown in UTC. Partition counts are left to the cluster.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with ``SETTINGS``; ``settings`` (dots as ``__``) come on top."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    extra = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
