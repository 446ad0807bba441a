"""Session settings that the engine relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC for all civil times, strict arithmetic, adaptive plans, and the last of two equal map keys.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def configure(spark: SparkSession) -> SparkSession:
    """Sets what can be set on a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(name: str = "ripplebook", cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for one machine."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name).config("spark.ui.enabled", "false")
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return configure(builder.config(map=SETTINGS).getOrCreate())
