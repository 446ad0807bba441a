"""Depth features: one row a book snapshot, row-local, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ripplebook import schemas
from ripplebook.functions import book, text
from ripplebook.functions.hashing import with_row_hash

QUANTITIES = (1, 5, 10)


def depth_feature(facts: DataFrame, quantities: tuple[int, ...] = QUANTITIES) -> DataFrame:
    """Spread, depths, and cost or proceeds of filling each quantity (null where the levels do not suffice).

    Each side is sorted once, in a projection of its own, and folded once a quantity.
    """
    sides = facts.withColumns({"__asks": book.sorted_levels(F.col("asks"), True), "__bids": book.sorted_levels(F.col("bids"), False)})
    fills = {f"buy_cost_{q}": book.fill_cost(F.col("__asks"), q) for q in quantities}
    fills |= {f"sell_proceeds_{q}": book.fill_cost(F.col("__bids"), q) for q in quantities}
    filled = sides.withColumns(fills)
    out = filled.select(
        F.lit(schemas.VERSION).alias("schema_version"), F.lit(schemas.DEPTH).alias("dataset_format"),
        text.key("pm_depth_feature", F.col("primary_key")).alias("primary_key"), F.col("primary_key").alias("source_book_primary_key"),
        "symbol", "condition_id", "asset_id", "outcome", "local_recv_ts_ns", "ingest_seq", "best_bid_price", "best_ask_price",
        book.spread(F.col("best_bid_price"), F.col("best_ask_price")).alias("spread"), "bid_depth_top10", "ask_depth_top10", *fills,
        *[F.col(f"buy_cost_{q}").isNotNull().alias(f"fillable_buy_{q}") for q in quantities],
        *[F.col(f"sell_proceeds_{q}").isNotNull().alias(f"fillable_sell_{q}") for q in quantities],
        F.lit(0).cast("bigint").alias("book_age_ms"),
    )
    return with_row_hash(out)
