"""The state store that keeps keyed state and timers."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTING = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def needs_rocks(spark: SparkSession) -> None:
    """State with timers lives in RocksDB; a session that chose no store gets it for queries started from now on."""
    if spark.conf.get(SETTING, None) in (None, "", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"):
        spark.conf.set(SETTING, ROCKS)
