"""The event index: depth features and reference bars in one numbered order, and look-ups back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplebook import schemas
from ripplebook.operators.facts import with_sequence

ORDER = ["event_ts_ns", "source_rank", "ingest_seq", "payload_row_hash", "payload_primary_key"]


def depth_events(depth: DataFrame) -> DataFrame:
    return depth.select(
        F.lit("pm_depth_feature").alias("event_type"), F.col("local_recv_ts_ns").alias("event_ts_ns"), F.lit(0).alias("source_rank"),
        "symbol", "condition_id", "asset_id", "outcome", F.lit("depth_feature_stream_v1").alias("payload_table"),
        F.col("primary_key").alias("payload_primary_key"), F.col("row_hash").alias("payload_row_hash"), "ingest_seq",
    )


def kline_events(klines: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return klines.select(
        F.lit("binance_reference_1s").alias("event_type"), F.col("synthetic_local_recv_ts_ns").alias("event_ts_ns"), F.lit(1).alias("source_rank"),
        "symbol", none.alias("condition_id"), none.alias("asset_id"), none.alias("outcome"), F.lit("binance_kline_1s_reference").alias("payload_table"),
        F.col("primary_key").alias("payload_primary_key"), F.col("row_hash").alias("payload_row_hash"), "ingest_seq",
    )


def event_index(depth: DataFrame, klines: DataFrame) -> DataFrame:
    """Both streams by (time, source, sequence, hash), numbered from 0; depth comes first at equal times."""
    both = depth_events(depth).unionByName(kline_events(klines))
    numbered = with_sequence(both, ORDER, "global_event_seq")
    rest = [c for c in both.columns if c != "ingest_seq"]
    return numbered.select(
        F.lit(schemas.VERSION).alias("schema_version"), F.lit(schemas.EVENTS).alias("dataset_format"), "global_event_seq", *rest
    )


def resolve(events: DataFrame, depth: DataFrame, klines: DataFrame) -> DataFrame:
    """Events with their payload's figures: two equi-joins on the payload key (an extension)."""
    d = depth.select(F.col("primary_key").alias("payload_primary_key"), "spread", "best_bid_price", "best_ask_price")
    k = klines.select(F.col("primary_key").alias("payload_primary_key"), F.col("close").alias("reference_close"))
    return events.join(d, "payload_primary_key", "left").join(k, "payload_primary_key", "left")
