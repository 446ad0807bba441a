"""Star-schema tables in the shapes of this engine: orders as book snapshots, events as bars, order states as settlements."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ns(ts):
    """Nanoseconds of a timestamp (session zone UTC)."""
    return F.unix_micros(ts.cast("timestamp")) * 1000


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot an order: its O lines are asks and its F lines bids, price per unit and quantity, by (price, size)."""
    level = F.struct((F.col("l_extendedprice") / F.col("l_quantity")).alias("price"), F.col("l_quantity").cast("double").alias("size"))
    side = lambda status: F.array_sort(F.collect_list(F.when(F.col("l_linestatus") == status, level)))
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(side("F").alias("bids"), side("O").alias("asks"))
    orders = table(spark, sf_dir, "orders")
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey).select(
        F.col("o_orderpriority").alias("symbol"), F.col("o_custkey").cast("string").alias("condition_id"),
        F.col("o_orderkey").cast("string").alias("asset_id"), F.col("o_orderstatus").alias("outcome"),
        _ns(F.col("o_orderdate")).alias("local_recv_ts_ns"), F.col("o_orderkey").alias("ingest_seq"), "bids", "asks",
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A one-second bar an event, in event order; one source without a symbol of its own."""
    close = _ns(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        F.lit(0).alias("record_idx"), F.lit(0).cast("bigint").alias("block"), F.col("event_id").alias("line_pos"), F.lit("events").alias("source_cache_name"),
        F.lit(None).cast("string").alias("record_symbol"), F.col("event_type").alias("symbol"),
        (close - 1_000_000_000).alias("bar_open_ts_ns"), close.alias("bar_close_ts_ns"),
        *[F.col("value").alias(c) for c in ("open", "high", "low", "close")], F.lit(1.0).alias("volume"),
    )


def settlement_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A label an order: F settled, O unsettled, P unknown; the winner is whether the order is worth over 150,000."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("condition_id"), F.col("o_orderkey").cast("string").alias("asset_id"), status.alias("outcome"),
        F.when(status == "F", "settled").when(status == "O", "unsettled").otherwise("unknown").alias("status"),
        (F.col("o_totalprice") > 150_000).alias("winner"), _ns(F.col("o_orderdate")).alias("settled_ts_ns"), F.lit("orders").alias("source_cache_name"),
    )


def assets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An asset list with repeats: a row a part supplied, by line."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("asset_id"), F.col("l_partkey").cast("string").alias("condition_id"),
        (F.col("l_orderkey") * 1_000_000_000 + F.col("l_partkey") * 10_000 + F.col("l_linenumber") * 1000 + F.col("l_suppkey")).alias("pos"),
    )
