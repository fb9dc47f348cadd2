"""Session settings the toolkit relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SESSION_CONF = {
    # Business dates become midnight UTC before they meet version bounds.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: small partitions are merged, joins turn into broadcasts when a
    # measured side is small, and the partitions of a hot key are split over several tasks.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Also the size of the files a partitioned fact is cut into.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
}


def get_session(app_name: str = "aprisco", **conf: str) -> SparkSession:
    """Session with the settings above; the master and memory come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
