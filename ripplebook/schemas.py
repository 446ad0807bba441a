"""Row schemas (as DDL), table places and format tags.

Format tags are ``<prefix>_<name>.v1``. Datasets written by another tool may carry another prefix: set
``RIPPLEBOOK_FORMAT_PREFIX`` to read and write theirs.
"""

from __future__ import annotations

import os

PREFIX = os.environ.get("RIPPLEBOOK_FORMAT_PREFIX", "ripplebook")
VERSION = 1


def tag(name: str) -> str:
    return f"{PREFIX}_{name}.v1"


PLAN, CACHE_MANIFEST, MARKET_DIM = tag("pipeline_plan"), tag("input_cache_manifest"), tag("market_dim")
BOOK, KLINE, SETTLEMENT = tag("polymarket_book_top10"), tag("binance_kline_1s_reference"), tag("polymarket_settlement")
AVAILABILITY, DEPTH, EVENTS = tag("input_availability"), tag("depth_feature_stream"), tag("standard_event_index")
MATERIALIZATION, DATASET, ACCEPTANCE = tag("materialization_report"), tag("dataset_manifest"), tag("acceptance_report")
RECORDER_CONFIG, RECORDER_STATE, RECORDER_MANIFEST = tag("recorder_config"), tag("recorder_state"), tag("recorder_manifest")

#: Where a dataset's tables and documents lie under its root (fixed values of the dataset format).
TABLES = {
    "market_dim": "tables/market_dim",
    "book": "tables/polymarket_book_top10",
    "kline": "tables/binance_kline_1s_reference",
    "settlement": "tables/polymarket_settlement",
    "availability": "tables/input_availability",
    "depth": "derived/depth_feature_stream_v1",
    "events": "streams/standard_event_index_v1",
}
MATERIALIZATION_REPORT = "manifests/materialization_report.json"
DATASET_MANIFEST = "manifests/dataset_manifest.json"
ACCEPTANCE_REPORT = "manifests/acceptance_report.json"

#: Field names that must not occur in a dataset (fixed values).
BANNED_FIELDS = ("fair_value", "model_probability", "edge", "trigger", "side_decision", "pnl", "tradeable_interval")
#: Raw book files by basename, cache groups and settlement states (fixed values of the input formats).
BOOK_FILES = ("polymarket_book_top10.jsonl", "pm_book_top10.jsonl")
KLINE_GROUP, SETTLEMENT_GROUP = "binance_1s_reference", "polymarket_settlement"
SETTLEMENT_STATES = ("settled", "unsettled", "unknown", "failed")

_LEVELS = "array<struct<price:double,size:double>>"
RAW_BOOK = (
    f"symbol string, condition_id string, asset_id string, outcome string, local_recv_ts_ns bigint, ingest_seq bigint, bids {_LEVELS}, asks {_LEVELS}"
)
RAW_KLINE = (
    "symbol string, bar_open_ts_ns bigint, bar_close_ts_ns bigint, open double, high double, low double, close double, volume double"
)
RAW_SETTLEMENT = (
    "condition_id string, asset_id string, outcome string, status string, winner boolean, settled_ts_ns bigint"
)
CACHE_RECORD = (
    "group string, name string, source_url string, symbol string, start_ts_ns bigint, end_ts_ns bigint, status string, "
    "cache_path string, missing_count bigint, failure_reason string, response_hash string"
)
REQUIRED_BOOK = ("symbol", "condition_id", "asset_id", "outcome", "local_recv_ts_ns", "ingest_seq")
REQUIRED_KLINE = ("bar_open_ts_ns", "bar_close_ts_ns", "open", "high", "low", "close", "volume")
REQUIRED_SETTLEMENT = ("condition_id", "asset_id", "outcome", "status")

_HEAD = "schema_version int, dataset_format string"
_IDENTITY = "symbol string, condition_id string, asset_id string, outcome string"
_PRICES = "best_bid_price double, best_ask_price double"
_DEPTHS = "bid_depth_top10 double, ask_depth_top10 double"
_FILLS = ", ".join(f"{c}_{q} {t}" for t, kinds in (("double", ("buy_cost", "sell_proceeds")), ("boolean", ("fillable_buy", "fillable_sell"))) for c in kinds for q in (1, 5, 10))
#: Columns of each table, for those stored as JSON lines.
TABLE_COLUMNS = {
    "market_dim": f"{_HEAD}, {_IDENTITY}, first_seen_ts_ns bigint, last_seen_ts_ns bigint, row_hash string",
    "book": f"{_HEAD}, primary_key string, {_IDENTITY}, local_recv_ts_ns bigint, ingest_seq bigint, {_PRICES}, {_DEPTHS}, bids {_LEVELS}, asks {_LEVELS}, "
    "raw_row_hash string, row_hash string",
    "kline": f"{_HEAD}, primary_key string, symbol string, bar_open_ts_ns bigint, bar_close_ts_ns bigint, synthetic_local_recv_ts_ns bigint, ingest_seq bigint, "
    "open double, high double, low double, close double, volume double, source_cache_name string, row_hash string",
    "settlement": f"{_HEAD}, primary_key string, condition_id string, asset_id string, outcome string, status string, winner boolean, settled_ts_ns bigint, "
    "source_cache_name string, row_hash string",
    "availability": f"{_HEAD}, group string, name string, source_url string, symbol string, start_ts_ns bigint, end_ts_ns bigint, status string, "
    "missing_count bigint, failure_reason string, response_hash string",
    "depth": f"{_HEAD}, primary_key string, source_book_primary_key string, {_IDENTITY}, local_recv_ts_ns bigint, ingest_seq bigint, {_PRICES}, spread double, "
    f"{_DEPTHS}, {_FILLS}, book_age_ms bigint, row_hash string",
    "events": f"{_HEAD}, global_event_seq bigint, event_type string, event_ts_ns bigint, source_rank int, {_IDENTITY}, payload_table string, "
    "payload_primary_key string, payload_row_hash string",
}
