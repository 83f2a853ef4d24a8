"""Session settings for large shuffles, plus the same settings for a session made elsewhere."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime SQL settings that keep skewed joins and large shuffles healthy.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs one more exchange later on.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # HotSpot leaves methods above 8000 bytes of bytecode uncompiled. Wide projections (34 text
    # casts per snapshot row) exceed that inside one fused method; below the limit Spark
    # splits them into small methods instead, about three times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Frames that are both laid out by match join on seats as they lie.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in SCALE_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "arenalake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create a session. On a cluster leave `master` unset; spark-submit names it.

    `shuffle_partitions` is the starting count; AQE coalesces it downwards, so on a big
    cluster choose it for the largest shuffle (about input bytes / 128 MB).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            builder = (
                builder.config("spark.ui.enabled", "false")
                .config("spark.ui.showConsoleProgress", "false")
                .config("spark.driver.bindAddress", "127.0.0.1")
                .config("spark.driver.host", "127.0.0.1")
                .config("spark.driver.memory", "8g")
            )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SCALE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
