"""Session settings every job starts from."""

from __future__ import annotations

from pyspark.sql import SparkSession

FORCE_SKEW_SPLIT = "spark.sql.adaptive.forceOptimizeSkewedJoin"
METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"

# AQE coalesces and splits shuffle partitions at run time, so joins on a hot key are cut into several tasks. Forced
# splitting does so also where a later step could have reused the partitioning (two joins on one key, say), which AQE would
# leave whole; Spark adds a shuffle in just those cases. The method limit keeps generated code small enough for the JVM to
# compile: rules over a few dozen columns make methods that HotSpot would interpret. UTC makes text-to-timestamp casts
# independent of the host. Operators never change a session.
DEFAULTS = {
    FORCE_SKEW_SPLIT: "true",
    METHOD_LIMIT: "8000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name: str, settings: dict[str, str] | None = None) -> SparkSession:
    """Start (or get) a session. ``settings`` win over the defaults; sizes and master come from spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
