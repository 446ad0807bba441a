"""The engine's registered queries over the star-schema tables, each with its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplebook import adapters, schemas
from ripplebook.functions import book, json_fields, research, text
from ripplebook.functions.hashing import digest_folds, hash_path, row_hash
from ripplebook.operators import assets, events, facts, features
from ripplebook.plans import dataset
from ripplebook.plans.guard import banned_in_lines, invalid_events
from ripplebook.plans.guard import missing_references as missing
from ripplebook.session import configure
from ripplebook.sources import durable, files, tables
from ripplebook.sources.durable import saved

#: Line quantities run from 1 to 50, so fills are asked for at these instead of 1, 5 and 10.
QUANTITIES = (10, 50, 100)
LATENCY_MS = 1000


def _books(spark: SparkSession, d: str) -> DataFrame:
    return facts.book_facts(adapters.books(spark, d))


def _depth(spark: SparkSession, d: str) -> DataFrame:
    return features.depth_feature(_books(spark, d), QUANTITIES)


def _klines(spark: SparkSession, d: str) -> DataFrame:
    return facts.kline_reference(adapters.bars(spark, d), LATENCY_MS)


def book_top_of_book(spark, d):
    return _books(spark, d).select("primary_key", "best_bid_price", "best_ask_price", "bid_depth_top10", "ask_depth_top10")


def depth_feature(spark, d):
    return _depth(spark, d).drop("schema_version", "dataset_format", "row_hash")


def fill_cost_buy(spark, d):
    b = adapters.books(spark, d)
    return b.select("asset_id", *[book.cost_to_buy(F.col("asks"), q).alias(f"buy_cost_{q}") for q in QUANTITIES])


def fill_cost_sell(spark, d):
    b = adapters.books(spark, d)
    return b.select("asset_id", *[book.proceeds_to_sell(F.col("bids"), q).alias(f"sell_proceeds_{q}") for q in QUANTITIES])


def market_dim(spark, d):
    return facts.market_dim(_books(spark, d)).select("symbol", "condition_id", "asset_id", "outcome", "first_seen_ts_ns", "last_seen_ts_ns")


def market_dim_by_customer(spark, d):
    """The same operator where keys repeat: a market a customer and status."""
    by = _books(spark, d).withColumn("asset_id", F.lit("all"))
    return facts.market_dim(by).select("symbol", "condition_id", "asset_id", "outcome", "first_seen_ts_ns", "last_seen_ts_ns")


def kline_reference(spark, d):
    return _klines(spark, d).select("primary_key", "symbol", "bar_close_ts_ns", "synthetic_local_recv_ts_ns", "ingest_seq", "close")


def settlement_guarded(spark, d):
    return facts.settlements(adapters.settlement_rows(spark, d)).select("primary_key", "status", "winner", "settled_ts_ns")


def event_index(spark, d):
    e = events.event_index(_depth(spark, d), _klines(spark, d))
    # hashes hold doubles as text and have no SQL form; ties of time and rank do not share a sequence number here
    return e.select("global_event_seq", "event_type", "event_ts_ns", "source_rank", "symbol", "condition_id", "asset_id", "outcome", "payload_table", "payload_primary_key")


#: A year of the orders' dates, in nanoseconds.
REPLAY = research.Interval(820_454_400_000_000_000, 852_076_800_000_000_000)


def replay_interval(spark, d):
    e = events.event_index(_depth(spark, d), _klines(spark, d))
    return research.replay(e, REPLAY).select("global_event_seq", "event_ts_ns", "payload_primary_key")


def resolved_events(spark, d):
    depth, klines = saved(_depth(spark, d), "depth"), saved(_klines(spark, d), "klines")  # read by the index and by both look-ups
    out = events.resolve(events.event_index(depth, klines), depth, klines)
    return out.select("global_event_seq", "payload_primary_key", "spread", "reference_close")


def edge_trigger_pnl(spark, d):
    li = adapters.table(spark, d, "lineitem")
    fair, price = F.col("l_extendedprice") / F.col("l_quantity"), F.col("l_extendedprice") * (1 - F.col("l_discount")) / F.col("l_quantity")
    edge = research.buy_edge(fair, price)
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", edge.alias("buy_edge"), research.sell_edge(fair, price).alias("sell_edge"),
        research.fires(edge, 50.0).alias("fires"), research.realized_pnl(F.col("l_extendedprice"), F.col("l_tax"), F.col("l_discount")).alias("pnl"),
    )


def top_n_levels(spark, d):
    """The best two levels of either side."""
    b = adapters.books(spark, d)
    side = lambda name, ascending: b.select("asset_id", F.lit(name).alias("side"), F.posexplode(book.top_levels(F.col(name), 2, ascending)).alias("pos", "x"))
    return side("asks", True).unionByName(side("bids", False)).select("asset_id", "side", "pos", "x.price", "x.size")


def valid_level_count(spark, d):
    b = adapters.books(spark, d)
    return b.select("asset_id", F.size(book.valid_levels(F.col("bids"))).alias("bids"), F.size(book.valid_levels(F.col("asks"))).alias("asks"))


def dedup_first_wins(spark, d):
    return assets.first_wins(adapters.assets(spark, d), "asset_id", ["pos"])


def dedup_last_wins(spark, d):
    return assets.last_wins(adapters.assets(spark, d), "asset_id", ["pos"])


def merge_assets(spark, d):
    a = adapters.assets(spark, d)
    half = F.col("asset_id").cast("bigint") % 2 == 0
    return assets.merge(a.filter(half).filter("pos % 3 = 0"), a, "asset_id", "pos")


def anti_prune(spark, d):
    customers = adapters.table(spark, d, "customer").select(F.col("c_custkey").alias("asset_id"), F.col("c_name").alias("symbol"))
    return assets.prune(customers, adapters.table(spark, d, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("asset_id")), "asset_id")


def take_assets(spark, d):
    return assets.take(adapters.table(spark, d, "supplier").select("s_suppkey", "s_name"), "s_suppkey", 24)


def yes_no_rows(spark, d):
    parts = adapters.table(spark, d, "part").select(
        F.col("p_brand").alias("symbol"), F.col("p_partkey").cast("string").alias("condition_id"),
        F.concat(F.lit("y"), "p_partkey").alias("yes_asset_id"), F.concat(F.lit("n"), "p_partkey").alias("no_asset_id"),
    )
    return assets.yes_no_rows(parts)


def accept_violations(spark, d):
    """Event rows that acceptance rejects: a settlement stream smuggled in."""
    o = adapters.table(spark, d, "orders")
    rows = o.select(
        F.col("o_orderkey").alias("global_event_seq"), F.when(F.col("o_orderstatus") == "P", "settlement").otherwise("pm_depth_feature").alias("event_type"),
        F.lit("depth_feature_stream_v1").alias("payload_table"), F.when(F.col("o_orderkey") % 100 == 0, "other.v1").otherwise("good.v1").alias("dataset_format"),
    )
    return invalid_events(rows, "good.v1").select("global_event_seq")


def settlement_row_hash(spark, d):
    s = adapters.settlement_rows(spark, d).select("condition_id", "asset_id", "outcome", "status", "settled_ts_ns")
    return s.select("asset_id", row_hash(s.columns).alias("row_hash"))


def hour_buckets(spark, d):
    ns = F.unix_micros(F.col("ts").cast("timestamp")) * 1000
    return adapters.table(spark, d, "events").select(text.hour_bucket(ns).alias("hour_bucket")).groupBy("hour_bucket").agg(F.count("*").alias("n"))


def outcome_names(spark, d):
    up = F.when(F.col("l_linestatus") == "O", " Up ").when(F.col("l_returnflag") == "R", "down").otherwise(F.col("l_returnflag"))
    return adapters.table(spark, d, "lineitem").select(text.outcome(up).alias("outcome")).groupBy("outcome").agg(F.count("*").alias("n"))


def symbols_named(spark, d):
    named = F.concat(F.lit("Will "), F.element_at(F.array(*map(F.lit, ("Bitcoin", "ETH", "solana", "ether-eal", "gold"))), (F.col("p_size") % 5 + 1).cast("int")), F.lit(" rise? "))
    return adapters.table(spark, d, "part").select("p_partkey", text.symbol_in(named, F.col("p_name")).alias("symbol"))


def safe_names(spark, d):
    return adapters.table(spark, d, "part").select("p_partkey", text.safe_name(F.concat("p_name", F.when(F.col("p_size") > 25, "/a.json").otherwise(" #"))).alias("file_name"))


def json_props(spark, d):
    v = F.parse_json("props")
    return adapters.table(spark, d, "events").select(
        "event_id", json_fields.string_field(v, "missing", "k").alias("as_string"), json_fields.number_field(v, "k").alias("as_number"), json_fields.bool_field(v, "k").alias("as_bool")
    )


def input_availability(spark, d):
    """Roll-up of cache records: counts by group and status."""
    o = adapters.table(spark, d, "orders")
    records = o.select(
        F.col("o_orderpriority").alias("group"), F.col("o_orderkey").cast("string").alias("name"), F.lit("u").alias("source_url"),
        F.lit(None).cast("string").alias("symbol"), F.lit(0).cast("bigint").alias("start_ts_ns"), F.lit(0).cast("bigint").alias("end_ts_ns"),
        F.when(F.col("o_orderstatus") == "F", "available").otherwise("failed").alias("status"),
        (F.col("o_orderstatus") != "F").cast("bigint").alias("missing_count"), F.lit(None).cast("string").alias("failure_reason"), F.lit(None).cast("string").alias("response_hash"),
    )
    return facts.input_availability(records).groupBy("group", "status").agg(F.count("*").alias("n"), F.sum("missing_count").alias("missing"))


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder among the intermediate tables; it goes with them when the driver ends."""
    return durable.folder(spark, name)


def cached_rows(spark, d):
    """Suppliers as cache files of JSON lines, in order, and nations as one that holds a JSON array: read back beside their
    records, and numbered by record and place."""
    root = _scratch(spark, "cache")
    suppliers = adapters.table(spark, d, "supplier").orderBy("s_suppkey").select(F.to_json(F.struct(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))).alias("value"))
    suppliers.write.text(files.join(root, "lines"))
    nations = adapters.table(spark, d, "nation").orderBy("n_nationkey").select("n_nationkey", "n_name").collect()  # the 25 rows of a dimension
    files.write_json(files.join(root, "nations.json"), [{"id": r[0], "name": r[1]} for r in nations])
    paths = [p for p in files.listing(files.join(root, "lines")) if "/part-" in p]
    records = [{"cache_path": p, "name": "suppliers", "symbol": "S"} for p in paths] + [{"cache_path": files.join(root, "nations.json"), "name": "nations", "symbol": None}]
    rows = dataset.cached_rows(spark, records, "id bigint, name string", ("id", "name"))
    numbered = facts.with_sequence(rows, ["record_idx", "block", "line_pos"], "seq")
    return numbered.select("seq", "id", "name", F.col("source_cache_name").alias("source"), F.col("record_symbol").alias("symbol"))


def json_lines(spark, d):
    """Properties of events as JSON lines with blank ones between, read back untyped."""
    root = _scratch(spark, "values")
    lines = adapters.table(spark, d, "events").select(F.explode(F.array("props", F.lit("  "), F.lit(""))).alias("value"))
    lines.write.text(root)
    return tables.read_values(spark, root).groupBy(json_fields.string_field(F.col("value"), "k").alias("k")).agg(F.count("*").alias("n"))


def json_times(spark, d):
    """Times of events as whole milliseconds, nanoseconds, digits as text, ISO text, and behind a blank or a null."""
    ms, n = F.unix_millis(F.col("ts").cast("timestamp")), F.col("event_id") % 6
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    text = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    forms = [text('{"t":', ms, "}"), text('{"t":', ms, "000000}"), text('{"t":"', ms, '"}'), text('{"t":"', iso, '"}'), text('{"t":" ","u":', ms, "}"), text('{"t":null,"u":"', iso, '"}')]
    record = F.element_at(F.array(*forms), (n + 1).cast("int"))
    return adapters.table(spark, d, "events").select("event_id", json_fields.timestamp_ms(F.parse_json(record), "t", "u").alias("ms"))


def json_flags(spark, d):
    """Booleans, their names as text, other text, and a second field to fall back on."""
    forms = ['{"a":true}', '{"a":false}', '{"a":"true"}', '{"a":"false"}', '{"a":"yes"}', '{"a":1,"b":true}', '{"b":"false"}']
    record = F.element_at(F.array(*map(F.lit, forms)), (F.col("event_id") % len(forms) + 1).cast("int"))
    return adapters.table(spark, d, "events").select("event_id", json_fields.bool_field(F.parse_json(record), "a", "b").alias("flag"))


def json_strings(spark, d):
    """Arrays of strings, plain, mixed, as JSON text, as JSON text that is not of strings only, and none at all."""
    brand, kind = F.col("p_brand"), F.col("p_type")
    forms = [
        F.to_json(F.struct(F.array(brand, kind).alias("v"))), F.concat(F.lit('{"v":[1,"'), brand, F.lit('",null,{"x":"y"}]}')),
        F.to_json(F.struct(F.to_json(F.array(brand, kind)).alias("v"))), F.lit('{"v":"[1,\\"x\\"]"}'), F.lit('{"w":[]}'),
    ]
    record = F.element_at(F.array(*forms), (F.col("p_size") % len(forms) + 1).cast("int"))
    found = json_fields.string_array(json_fields.field(F.parse_json(record), "v"))
    return adapters.table(spark, d, "part").select("p_partkey", F.size(found).alias("n"), F.array_join(found, "|").alias("joined"))


def window_floors(spark, d):
    start = text.window_floor(F.unix_seconds(F.col("ts").cast("timestamp")))
    return adapters.table(spark, d, "events").select(start.alias("window_start_s")).groupBy("window_start_s").agg(F.count("*").alias("n"))


def missing_references(spark, d):
    """Of cache records, those of the bars' group that are not available."""
    o = adapters.table(spark, d, "orders")
    records = o.select(
        F.when(F.col("o_orderkey") % 2 == 0, schemas.KLINE_GROUP).otherwise(schemas.SETTLEMENT_GROUP).alias("group"), F.col("o_orderkey").cast("string").alias("name"),
        F.when(F.col("o_orderstatus") == "F", "available").when(F.col("o_orderstatus") == "O", "missing").otherwise("failed").alias("status"),
    )
    return missing(records).select("name", "status")


def zipped_outcomes(spark, d):
    """Three tokens a part beside none to five outcome names."""
    names = F.transform(F.sequence(F.lit(1), F.col("p_size") % 6), lambda k: F.concat(F.lit("name"), k.cast("string")))
    names = F.when(F.col("p_size") % 6 > 0, names).otherwise(F.array().cast("array<string>"))
    tokens = F.transform(F.array(*[F.lit(k) for k in range(3)]), lambda k: F.concat(F.col("p_partkey").cast("string"), F.lit("-"), k.cast("string")))
    return assets.zip_outcomes(adapters.table(spark, d, "part").select("p_partkey", names.alias("names"), tokens.alias("tokens")), "names", "tokens")


def field_names(spark, d):
    names = tables.field_names(adapters.table(spark, d, "lineitem"))
    return spark.createDataFrame(list(enumerate(names)), "pos int, field string")


def table_digests(spark, d):
    """The folds of a table's digest, which do not depend on the order of rows."""
    s = adapters.settlement_rows(spark, d).select("condition_id", "asset_id", "outcome", "status", "settled_ts_ns")
    return digest_folds(s)


def folder_digest(spark, d):
    """The hash of a folder of small files: a document a region, in a folder a first letter."""
    root = _scratch(spark, "documents")
    for r in adapters.table(spark, d, "region").select("r_name").collect():  # the five rows of a dimension
        files.write_bytes(files.join(root, r.r_name[0], f"{r.r_name}.txt"), f"region {r.r_name}\n".encode())
    return spark.createDataFrame([(hash_path(root),)], "folder_hash string")


def banned_keys(spark, d):
    """JSON lines in a folder an event type, some with a banned key deep inside: the keys found by folder."""
    root, n = files.join(_scratch(spark, "lines"), "t"), F.col("event_id")
    inner = F.when((n % 7 == 0) & (F.col("event_type") != "view"), '[{"x":{"edge":1}}]').when(n % 11 == 3, '{"pnl":[{"edges":2}]}').otherwise('"edge"')
    lines = adapters.table(spark, d, "events").select("event_type", F.concat(F.lit('{"id":'), n.cast("string"), F.lit(',"in":'), inner, F.lit("}")).alias("value"))
    lines.write.partitionBy("event_type").text(root)
    found = banned_in_lines(spark, [root])
    return found.select(F.regexp_extract("path", "event_type=([^/]*)/", 1).alias("event_type"), "field").distinct()


_BOOK = """
b AS (SELECT l_orderkey, list({price: l_extendedprice / l_quantity, size: CAST(l_quantity AS DOUBLE)} ORDER BY l_extendedprice / l_quantity, l_quantity) FILTER (l_linestatus = 'F') AS bids,
             list({price: l_extendedprice / l_quantity, size: CAST(l_quantity AS DOUBLE)} ORDER BY l_extendedprice / l_quantity, l_quantity) FILTER (l_linestatus = 'O') AS asks
      FROM lineitem GROUP BY l_orderkey),
s AS (SELECT o_orderpriority AS symbol, CAST(o_custkey AS VARCHAR) AS condition_id, CAST(o_orderkey AS VARCHAR) AS asset_id, o_orderstatus AS outcome,
             epoch_ns(o_orderdate) AS local_recv_ts_ns, o_orderkey AS ingest_seq, coalesce(bids, []) AS bids, coalesce(asks, []) AS asks,
             'pm_book:' || o_custkey || ':' || o_orderkey || ':' || epoch_ns(o_orderdate) || ':' || o_orderkey AS primary_key
      FROM orders JOIN b ON o_orderkey = l_orderkey)"""


def _fold(levels: str, q: int) -> str:
    start = f"{{price: 0.0::DOUBLE, size: {q}.0::DOUBLE}}"  # the running (cost, left) in a level's shape
    step = "lambda a, x: CASE WHEN a.size <= 2.220446049250313e-16 OR x.size <= 0 THEN a ELSE {price: a.price + least(a.size, x.size) * x.price, size: a.size - least(a.size, x.size)} END"
    fold = f"list_reduce({levels}, {step}, {start})"
    return f"CASE WHEN len({levels}) > 0 AND {fold}.size <= 2.220446049250313e-16 THEN {fold}.price END"


_BUY = ", ".join(f"{_fold('asks', q)} AS buy_cost_{q}" for q in QUANTITIES)
# bids are sorted by (price, size) ascending; the sort by price alone, descending, keeps the sizes of a price in ascending order
_SELL_LEVELS = "list_transform(list_sort(list_transform(bids, lambda x: {p: -x.price, price: x.price, size: x.size})), lambda x: {price: x.price, size: x.size})"
_SELL = ", ".join(f"{_fold('downs', q)} AS sell_proceeds_{q}" for q in QUANTITIES)
_SUM = "list_reduce(list_transform({0}, lambda x: x.size), lambda a, x: a + x, 0.0::DOUBLE)"
_TOP = f"""list_max(list_transform(bids, lambda x: x.price)) AS best_bid_price, list_min(list_transform(asks, lambda x: x.price)) AS best_ask_price,
  {_SUM.format("bids")} AS bid_depth_top10, {_SUM.format("asks")} AS ask_depth_top10"""
_DEPTH = f""", t AS (SELECT *, {_SELL_LEVELS} AS downs, {_TOP} FROM s), f AS (SELECT *, {_BUY}, {_SELL} FROM t)"""
_EVENTS = """, ev AS (
 SELECT 'pm_depth_feature' AS event_type, local_recv_ts_ns AS event_ts_ns, 0 AS source_rank, symbol, condition_id, asset_id, outcome,
        'depth_feature_stream_v1' AS payload_table, 'pm_depth_feature:' || primary_key AS payload_primary_key, ingest_seq FROM s
 UNION ALL
 SELECT 'binance_reference_1s', epoch_ns(ts) + 1000000000, 1, event_type, NULL, NULL, NULL, 'binance_kline_1s_reference',
        'bn_1s:' || event_type || ':' || epoch_ns(ts), row_number() OVER (ORDER BY event_id) - 1 FROM events),
n AS (SELECT row_number() OVER (ORDER BY event_ts_ns, source_rank, ingest_seq) - 1 AS global_event_seq, * EXCLUDE (ingest_seq) FROM ev)"""
_ASSETS = "SELECT CAST(l_suppkey AS VARCHAR) AS asset_id, CAST(l_partkey AS VARCHAR) AS condition_id, l_orderkey * 1000000000 + l_partkey * 10000 + l_linenumber * 1000 + l_suppkey AS pos FROM lineitem"

ORACLE_SQL: dict[str, str] = {
    "book_top_of_book": f"WITH {_BOOK} SELECT primary_key, {_TOP} FROM s",
    "fill_cost_buy": f"WITH {_BOOK} SELECT asset_id, {_BUY} FROM s",
    "fill_cost_sell": f"WITH {_BOOK}, t AS (SELECT *, {_SELL_LEVELS} AS downs FROM s) SELECT asset_id, {_SELL} FROM t",
    "depth_feature": f"""WITH {_BOOK}{_DEPTH} SELECT 'pm_depth_feature:' || primary_key AS primary_key, primary_key AS source_book_primary_key, symbol, condition_id, asset_id,
 outcome, local_recv_ts_ns, ingest_seq, best_bid_price, best_ask_price, best_ask_price - best_bid_price AS spread, bid_depth_top10, ask_depth_top10,
 {", ".join(f"buy_cost_{q}, sell_proceeds_{q}, buy_cost_{q} IS NOT NULL AS fillable_buy_{q}, sell_proceeds_{q} IS NOT NULL AS fillable_sell_{q}" for q in QUANTITIES)},
 CAST(0 AS BIGINT) AS book_age_ms FROM f""",
    "market_dim": f"WITH {_BOOK} SELECT arg_min(symbol, (local_recv_ts_ns, ingest_seq)) AS symbol, condition_id, asset_id, outcome, min(local_recv_ts_ns) AS first_seen_ts_ns, max(local_recv_ts_ns) AS last_seen_ts_ns FROM s GROUP BY condition_id, asset_id, outcome",
    "market_dim_by_customer": f"WITH {_BOOK} SELECT arg_min(symbol, (local_recv_ts_ns, ingest_seq)) AS symbol, condition_id, 'all' AS asset_id, outcome, min(local_recv_ts_ns) AS first_seen_ts_ns, max(local_recv_ts_ns) AS last_seen_ts_ns FROM s GROUP BY condition_id, outcome",
    "kline_reference": "SELECT 'bn_1s:' || event_type || ':' || epoch_ns(ts) AS primary_key, event_type AS symbol, epoch_ns(ts) AS bar_close_ts_ns, epoch_ns(ts) + 1000000000 AS synthetic_local_recv_ts_ns, row_number() OVER (ORDER BY event_id) - 1 AS ingest_seq, value AS close FROM events",
    "settlement_guarded": "SELECT 'pm_settlement:' || o_custkey || ':' || o_orderkey || ':' || o_orderstatus AS primary_key, CASE o_orderstatus WHEN 'F' THEN 'settled' WHEN 'O' THEN 'unsettled' ELSE 'unknown' END AS status, CASE WHEN o_orderstatus = 'F' THEN o_totalprice > 150000 END AS winner, epoch_ns(o_orderdate) AS settled_ts_ns FROM orders",
    "event_index": f"WITH {_BOOK}{_EVENTS} SELECT * FROM n",
    "replay_interval": f"WITH {_BOOK}{_EVENTS} SELECT global_event_seq, event_ts_ns, payload_primary_key FROM n WHERE event_ts_ns BETWEEN {REPLAY.start_ts_ns} AND {REPLAY.end_ts_ns}",
    "resolved_events": f"WITH {_BOOK}{_EVENTS}{_DEPTH} SELECT global_event_seq, payload_primary_key, best_ask_price - best_bid_price AS spread, value AS reference_close FROM n LEFT JOIN f ON payload_primary_key = 'pm_depth_feature:' || primary_key LEFT JOIN events e ON payload_primary_key = 'bn_1s:' || e.event_type || ':' || epoch_ns(ts)",
    "edge_trigger_pnl": "WITH p AS (SELECT *, l_extendedprice / l_quantity AS fair, l_extendedprice * (1 - l_discount) / l_quantity AS price FROM lineitem) SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, fair - price AS buy_edge, price - fair AS sell_edge, fair - price >= 50.0 AS fires, l_extendedprice + l_tax - l_discount AS pnl FROM p",
    "top_n_levels": f"""WITH {_BOOK}, t AS (SELECT asset_id, 'asks' AS side, asks AS levels FROM s UNION ALL SELECT asset_id, 'bids', {_SELL_LEVELS} FROM s)
SELECT asset_id, side, pos, levels[pos + 1].price AS price, levels[pos + 1].size AS size FROM (SELECT *, CAST(unnest(range(least(len(levels), 2))) AS INTEGER) AS pos FROM t)""",
    "valid_level_count": f"WITH {_BOOK} SELECT asset_id, CAST(len(bids) AS INTEGER) AS bids, CAST(len(asks) AS INTEGER) AS asks FROM s",
    "dedup_first_wins": f"SELECT * FROM ({_ASSETS}) QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY pos) = 1",
    "dedup_last_wins": f"SELECT * FROM ({_ASSETS}) QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY pos DESC) = 1",
    "merge_assets": f"WITH a AS ({_ASSETS}), u AS (SELECT *, 0 AS src FROM a WHERE CAST(asset_id AS BIGINT) % 2 = 0 AND pos % 3 = 0 UNION ALL SELECT *, 1 FROM a) SELECT asset_id, condition_id, pos FROM u QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY src, pos) = 1",
    "anti_prune": "SELECT c_custkey AS asset_id, c_name AS symbol FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')",
    "take_assets": "SELECT s_suppkey, s_name FROM supplier ORDER BY s_suppkey LIMIT 24",
    "yes_no_rows": "SELECT p_brand AS symbol, CAST(p_partkey AS VARCHAR) AS condition_id, 'YES' AS outcome, 'y' || p_partkey AS asset_id FROM part UNION ALL SELECT p_brand, CAST(p_partkey AS VARCHAR), 'NO', 'n' || p_partkey FROM part",
    "accept_violations": "SELECT o_orderkey AS global_event_seq FROM orders WHERE o_orderstatus = 'P' OR o_orderkey % 100 = 0",
    "settlement_row_hash": """SELECT CAST(o_orderkey AS VARCHAR) AS asset_id, sha256('{"asset_id":"' || o_orderkey || '","condition_id":"' || o_custkey || '","outcome":"' || o_orderstatus || '","settled_ts_ns":' || epoch_ns(o_orderdate) || ',"status":"' || CASE o_orderstatus WHEN 'F' THEN 'settled' WHEN 'O' THEN 'unsettled' ELSE 'unknown' END || '"}') AS row_hash FROM orders""",
    "hour_buckets": "SELECT epoch_ns(ts) // 3600000000000 AS hour_bucket, count(*) AS n FROM events GROUP BY 1",
    "outcome_names": "SELECT CASE WHEN l_linestatus = 'O' THEN 'YES' WHEN l_returnflag = 'R' THEN 'NO' ELSE l_returnflag END AS outcome, count(*) AS n FROM lineitem GROUP BY 1",
    "symbols_named": "SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'BTC' WHEN 1 THEN 'ETH' WHEN 2 THEN 'SOL' WHEN 3 THEN 'ETH' END AS symbol FROM part",
    "safe_names": r"SELECT p_partkey, CASE WHEN p_size > 25 THEN regexp_replace(p_name || '/a.json', '[^A-Za-z0-9._-]', '_', 'g') ELSE regexp_replace(p_name || ' #', '[^A-Za-z0-9._-]', '_', 'g') || '.jsonl' END AS file_name FROM part",
    "json_props": "SELECT event_id, json_extract_string(props, '$.k') AS as_string, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS as_number, CAST(NULL AS BOOLEAN) AS as_bool FROM events",
    "input_availability": "SELECT o_orderpriority AS \"group\", CASE WHEN o_orderstatus = 'F' THEN 'available' ELSE 'failed' END AS status, count(*) AS n, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END) AS BIGINT) AS missing FROM orders GROUP BY 1, 2",
}

_JSON_ROW = """'{"asset_id":"' || o_orderkey || '","condition_id":"' || o_custkey || '","outcome":"' || o_orderstatus || '","settled_ts_ns":' || epoch_ns(o_orderdate) || ',"status":"' || CASE o_orderstatus WHEN 'F' THEN 'settled' WHEN 'O' THEN 'unsettled' ELSE 'unknown' END || '"}'"""
ORACLE_SQL |= {
    "cached_rows": "SELECT row_number() OVER (ORDER BY k, id) - 1 AS seq, id, name, source, symbol FROM (SELECT 0 AS k, s_suppkey AS id, s_name AS name, 'suppliers' AS source, 'S' AS symbol FROM supplier UNION ALL SELECT 1, n_nationkey, n_name, 'nations', NULL FROM nation)",
    "json_lines": "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1",
    "json_times": "SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events",
    "json_flags": "SELECT event_id, CASE event_id % 7 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false WHEN 5 THEN true WHEN 6 THEN false END AS flag FROM events",
    "json_strings": "SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 2 WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE 0 END::INTEGER AS n, CASE p_size % 5 WHEN 0 THEN p_brand || '|' || p_type WHEN 1 THEN p_brand WHEN 2 THEN p_brand || '|' || p_type ELSE '' END AS joined FROM part",
    "window_floors": "SELECT CAST(epoch_us(ts) // 300000000 * 300 AS BIGINT) AS window_start_s, count(*) AS n FROM events GROUP BY 1",
    "missing_references": "SELECT CAST(o_orderkey AS VARCHAR) AS name, CASE o_orderstatus WHEN 'O' THEN 'missing' ELSE 'failed' END AS status FROM orders WHERE o_orderkey % 2 = 0 AND o_orderstatus <> 'F'",
    "zipped_outcomes": "SELECT p_partkey, CAST(pos AS INTEGER) AS pos, p_partkey || '-' || pos AS token, CASE WHEN pos < p_size % 6 THEN 'name' || (pos + 1) ELSE 'outcome-' || pos END AS outcome FROM part, range(3) r(pos)",
    "field_names": "SELECT CAST(row_number() OVER (ORDER BY column_name) - 1 AS INTEGER) AS pos, column_name AS field FROM (DESCRIBE lineitem)",
    "table_digests": f"SELECT count(*) AS row_count, bit_xor(h) AS xor60, CAST(sum(h) AS VARCHAR) AS sum60 FROM (SELECT CAST('0x' || substr(sha256({_JSON_ROW}), 1, 15) AS BIGINT) AS h FROM orders)",
    "folder_digest": "SELECT sha256(string_agg(r_name[1] || '/' || r_name || '.txt' || chr(0) || 'region ' || r_name || chr(10) || chr(0), '' ORDER BY r_name[1] || '/' || r_name || '.txt')) AS folder_hash FROM region",
    "banned_keys": "SELECT DISTINCT event_type, CASE WHEN event_id % 7 = 0 AND event_type <> 'view' THEN 'edge' ELSE 'pnl' END AS field FROM events WHERE (event_id % 7 = 0 AND event_type <> 'view') OR event_id % 11 = 3",
}

_HERE = globals()


def _registered(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _HERE[name](configure(spark), sf_dir)

    run.__name__, run.__doc__ = name, _HERE[name].__doc__
    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {name: _registered(name) for name in ORACLE_SQL}
