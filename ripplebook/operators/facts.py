"""Fact tables: book snapshots, market dimension, reference bars, settlements, input availability."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplebook import schemas
from ripplebook.functions import book, text
from ripplebook.functions.hashing import row_hash, with_row_hash
from ripplebook.sources.durable import saved

IDENTITY = ("symbol", "condition_id", "asset_id", "outcome")


def _tagged(df: DataFrame, dataset_format: str) -> DataFrame:
    return df.select(F.lit(schemas.VERSION).alias("schema_version"), F.lit(dataset_format).alias("dataset_format"), *df.columns)


def book_facts(raw: DataFrame) -> DataFrame:
    """One row a snapshot, repeats kept: key, best prices, depths and hashes. Row-local."""
    raw = raw.withColumn("raw_row_hash", row_hash(raw.columns))
    key = text.key("pm_book", *[F.col(c) for c in ("condition_id", "asset_id", "local_recv_ts_ns", "ingest_seq")])
    facts = raw.select(
        key.alias("primary_key"), *IDENTITY, "local_recv_ts_ns", "ingest_seq",
        book.best_bid(F.col("bids")).alias("best_bid_price"), book.best_ask(F.col("asks")).alias("best_ask_price"),
        book.depth(F.col("bids")).alias("bid_depth_top10"), book.depth(F.col("asks")).alias("ask_depth_top10"),
        "bids", "asks", "raw_row_hash",
    )
    return with_row_hash(_tagged(facts, schemas.BOOK))


def market_dim(facts: DataFrame) -> DataFrame:
    """One row a (condition, asset, outcome): first and last time seen, and the symbol of the first snapshot.

    Partial aggregation; ``min_by`` on an order of (time, sequence, key) picks the first row's symbol.
    """
    first = F.struct("local_recv_ts_ns", "ingest_seq", "primary_key")
    dim = facts.groupBy("condition_id", "asset_id", "outcome").agg(
        F.min_by("symbol", first).alias("symbol"),
        F.min("local_recv_ts_ns").alias("first_seen_ts_ns"),
        F.max("local_recv_ts_ns").alias("last_seen_ts_ns"),
    )
    dim = dim.select(*IDENTITY, "first_seen_ts_ns", "last_seen_ts_ns")
    return with_row_hash(_tagged(dim, schemas.MARKET_DIM))


def kline_reference(bars: DataFrame, latency_ms: int) -> DataFrame:
    """Bars of all available sources: ``bars`` has record_idx, block, line_pos, source_cache_name, record_symbol and the raw bar.

    The symbol is the bar's own, else its source's (neither: fails). ``ingest_seq`` is the place in (source,
    place in its file) order over all sources. The receive time is the close plus the latency, checked for overflow.
    """
    shift = latency_ms * 1_000_000
    if abs(shift) >= 1 << 63:
        raise OverflowError("reference latency")
    missing = F.raise_error(F.concat(F.lit("bar without symbol in "), F.col("source_cache_name")))
    bars = bars.withColumn("symbol", F.coalesce("symbol", "record_symbol", missing))
    # bars are read and cast, nothing more: finding the ranges reads them a second time, which costs less than writing them
    bars = with_sequence(bars, ["record_idx", "block", "line_pos"], "ingest_seq", write_first=False)
    out = bars.select(
        text.key("bn_1s", F.col("symbol"), F.col("bar_close_ts_ns")).alias("primary_key"), "symbol", "bar_open_ts_ns", "bar_close_ts_ns",
        (F.col("bar_close_ts_ns") + F.lit(shift)).alias("synthetic_local_recv_ts_ns"), "ingest_seq",
        "open", "high", "low", "close", "volume", "source_cache_name",
    )
    return with_row_hash(_tagged(out, schemas.KLINE))


def settlements(rows: DataFrame) -> DataFrame:
    """Settlement labels; the winner is known only where the state is ``settled``."""
    out = rows.select(
        text.key("pm_settlement", F.col("condition_id"), F.col("asset_id"), F.col("outcome")).alias("primary_key"),
        "condition_id", "asset_id", "outcome", "status",
        F.when(F.col("status") == "settled", F.col("winner")).alias("winner"), "settled_ts_ns", "source_cache_name",
    )
    return with_row_hash(_tagged(out, schemas.SETTLEMENT))


def input_availability(records: DataFrame) -> DataFrame:
    """A row a cache record, without its path."""
    names = ["group", "name", "source_url", "symbol", "start_ts_ns", "end_ts_ns", "status", "missing_count", "failure_reason", "response_hash"]
    return _tagged(records.select(*names), schemas.AVAILABILITY)


def with_sequence(df: DataFrame, order: list[str], name: str, *, write_first: bool = True) -> DataFrame:
    """A dense 0-based number in the order given, which must be total for the result to be fixed.

    One plan at every size: rows are range-partitioned and sorted, numbered within their partition and shifted by the
    sizes of the partitions before (a row a partition). Finding the ranges and dealing the rows out each read the input:
    ``write_first`` has ``df`` computed and written once before.
    """
    first = saved(df, "sequence-input") if write_first else df
    ranged = first.repartitionByRange(*order).sortWithinPartitions(*order)
    # within one task the id counts its rows, in the sorted order; the high bits are the partition
    ranged = saved(ranged.withColumn("__at", F.monotonically_increasing_id()), "sequence")
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = ranged.groupBy(part.alias("__part")).agg(F.count("*").alias("n")).orderBy("__part").collect()
    before, total = [], 0
    for r in sizes:
        before.append((r["__part"], total))
        total += r["n"]
    offsets = df.sparkSession.createDataFrame(before, "__part bigint, __before bigint")
    out = ranged.withColumn("__part", part).join(F.broadcast(offsets), "__part")
    return out.withColumn(name, F.col("__before") + place).drop("__at", "__part", "__before")
