"""The build chain on small made-up markets: costs against an independent loop, layouts, guards, acceptance, export, research load."""

import json
import os
import shutil
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ripplebook import schemas
from ripplebook.plans import dataset, guard
from ripplebook.sources import files, inputs, tables

MARKET = {"symbol": "DOGE-RAIN", "condition_id": "weather#9", "asset_id": "wet"}


def level(*pairs):
    return [{"price": p, "size": s} for p, s in pairs]


#: Three snapshots: a deep book, one without bids, and one whose levels come in no order and hold a size of zero.
BOOKS = [
    MARKET | {"outcome": "WET", "local_recv_ts_ns": 41_000_000_500, "ingest_seq": 3, "bids": level((0.31, 6.0), (0.29, 1.5), (0.28, 9.0)), "asks": level((0.37, 0.75), (0.41, 8.5))},
    MARKET | {"outcome": "WET", "local_recv_ts_ns": 40_500_000_000, "ingest_seq": 2, "bids": [], "asks": level((0.9, 2.25))},
    MARKET | {"asset_id": "dry", "outcome": "DRY", "local_recv_ts_ns": 41_000_000_500, "ingest_seq": 4, "bids": level((0.55, 3.0), (0.61, 0.0), (0.58, 2.5)), "asks": level((0.72, 11.0), (0.66, 0.5))},
]
#: Of the two bars one is received, with the plan's latency, just when two of the snapshots are.
BARS = [{"symbol": "RAINFALL", "bar_open_ts_ns": a, "bar_close_ts_ns": a + 1_000_000_000, "open": 7.25, "high": 9.0, "low": 6.5, "close": c, "volume": 3.0} for a, c in ((39_000_000_500, 8.75), (42_000_000_000, 8.5))]
LABELS = [MARKET | {"outcome": "WET", "status": s, "winner": True, "settled_ts_ns": None} for s in ("failed",)]
LABELS = [{k: v for k, v in x.items() if k != "symbol"} for x in LABELS]


def put(path, *rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.writelines(json.dumps(r) + "\n\n" for r in rows)
    return str(path)


def walked(levels, quantity):
    """What filling ``quantity`` from the best level on costs, level by level; None if it cannot be filled."""
    left, cost = quantity, 0.0
    for x in levels:
        if x["size"] > 0 and left > 0:
            got = min(left, x["size"])
            left, cost = left - got, cost + got * x["price"]
    return cost if left == 0 else None


@pytest.fixture
def plan(tmp_path):
    put(tmp_path / "raw/a/b/polymarket_book_top10.jsonl", *BOOKS[:2])
    put(tmp_path / "raw/pm_book_top10.jsonl", *BOOKS[2:])
    put(tmp_path / "raw/a/notes.jsonl", {"unread": True})
    bars, labels = put(tmp_path / "fetched/bars.jsonl", *BARS), put(tmp_path / "fetched/labels.jsonl", *LABELS)
    return inputs.Plan(
        [str(tmp_path / "raw")], str(tmp_path / "plan"), str(tmp_path / "cache"), str(tmp_path / "data"),
        binance_sources=[inputs.SourceSpec("bars", bars)], settlement_sources=[inputs.SourceSpec("labels", f"file://{labels}")],
    )


def build(spark, plan, layout="parquet"):
    inputs.sync_inputs(plan)
    report = dataset.build_facts(spark, plan, layout)
    dataset.build_depth_feature(spark, plan, layout)
    return report, dataset.build_event_index(spark, plan, layout)


def test_costs_against_a_walk_of_the_book(spark, plan):
    build(spark, plan)
    got = {r.ingest_seq: r for r in spark.read.parquet(plan.path("depth")).collect()}
    for b in BOOKS:
        row = got[b["ingest_seq"]]
        asks, bids = sorted(b["asks"], key=lambda x: x["price"]), sorted(b["bids"], key=lambda x: -x["price"])
        for q in (1, 5, 10):
            for side, levels, name in (("buy_cost", asks, "buy"), ("sell_proceeds", bids, "sell")):
                want = walked(levels, q)
                assert row[f"{side}_{q}"] == (pytest.approx(want) if want is not None else None) and row[f"fillable_{name}_{q}"] == (want is not None)
        assert row.ask_depth_top10 == sum(x["size"] for x in asks) and row.best_bid_price == max((x["price"] for x in bids), default=None)


@pytest.mark.parametrize("layout", ["parquet", "jsonl"])
def test_chain(spark, plan, tmp_path, layout):
    assert inputs.load_plan(inputs.write_plan(plan)) == plan
    report, events = build(spark, plan, layout)
    got = events.orderBy("global_event_seq").collect()
    # by time, and depth before bars where times are equal
    assert [(r.global_event_seq, r.source_rank, r.event_ts_ns) for r in got] == [(0, 0, 40_500_000_000), (1, 0, 41_000_000_500), (2, 0, 41_000_000_500), (3, 1, 41_000_000_500), (4, 1, 44_000_000_000)]
    assert {r.dataset_format for r in got} == {schemas.EVENTS} and all(r.payload_row_hash for r in got)
    assert dataset.accept(spark, plan)["accepted"]
    before = dataset.read_dataset_manifest(plan)
    again, _ = build(spark, plan, layout)
    assert again["table_hashes"] == report["table_hashes"]
    assert {k: v for k, v in dataset.read_dataset_manifest(plan).items() if k.endswith("hash")} == {k: v for k, v in before.items() if k.endswith("hash")}
    dataset.accept(spark, plan)
    dataset.export_dataset(plan, f"file://{tmp_path}/out")
    loaded = dataset.load_backtest_inputs(spark, f"file://{tmp_path}/out")
    assert {k: v.count() for k, v in loaded.items()} == {"events": 5, "depth": 3, "klines": 2, "settlements": 1}
    assert loaded["settlements"].first().winner is None  # known only where the state is settled
    for name in ("nested", ""):
        with pytest.raises(ValueError):
            dataset.export_dataset(plan, os.path.join(plan.dataset_root, name))


def test_both_layouts_hold_the_same_rows(spark, plan, tmp_path):
    twin = replace(plan, dataset_root=str(tmp_path / "twin"))
    a, b = build(spark, plan)[0], build(spark, twin, "jsonl")[0]
    assert a["table_hashes"] == b["table_hashes"] and a["row_counts"] == b["row_counts"]
    for name in schemas.TABLES:
        one, other = dataset._read(spark, plan, name), dataset._read(spark, twin, name)
        assert one.dtypes == other.select(*one.columns).dtypes == spark.createDataFrame([], schemas.TABLE_COLUMNS[name]).select(*one.columns).dtypes
        assert sorted(map(str, one.collect())) == sorted(map(str, other.select(*one.columns).collect()))


def test_depth_reads_only_the_book(spark, plan):
    inputs.sync_inputs(plan)
    dataset.build_facts(spark, plan)
    for t in ("kline", "settlement"):
        shutil.rmtree(plan.path(t))
    assert dataset.build_depth_feature(spark, plan).count() == 3


def test_an_absent_source_fails_closed(spark, plan):
    plan = replace(plan, binance_sources=[inputs.SourceSpec("nowhere", "/absent/bars")], accept_fail_closed_on_missing_reference=True)
    _, events = build(spark, plan)
    row = spark.read.parquet(plan.path("availability")).filter("name = 'nowhere'").first()
    assert row.status == "failed" and row.missing_count == 1 and events.count() == 3
    with pytest.raises(dataset.NotAccepted, match="nowhere"):
        dataset.accept(spark, plan)
    with pytest.raises(dataset.NotAccepted):
        dataset.export_dataset(plan, plan.dataset_root + "-out")


def test_the_guard_finds_keys_at_any_depth_on_any_file_system(spark, plan):
    build(spark, plan)
    root = f"file://{plan.dataset_root}"
    assert guard.banned_fields(spark, root) == []
    put(os.path.join(plan.dataset_root, "tables/odd/rows.jsonl"), {"a": {"b": [[{"pnl": None}]]}}, {"a": 1})
    put(os.path.join(plan.dataset_root, "odd/document.json"), {"list": [{"edge": 2}]})
    spark.range(1).select(F.struct(F.col("id").alias("fair_value")).alias("s")).write.parquet(f"{root}/odd/nested")
    assert {f for _, f in guard.banned_fields(spark, root)} == {"pnl", "edge", "fair_value"}
    with pytest.raises(dataset.NotAccepted, match="fair_value"):
        dataset.accept(spark, plan)


def test_the_guard_does_not_pass_what_it_cannot_list(spark, plan, tmp_path):
    for root in (f"file://{tmp_path}/absent", "nosuchscheme://host/data"):
        with pytest.raises(Exception, match="absent|nosuchscheme"):
            guard.banned_fields(spark, root)
    with pytest.raises(Exception, match="data"):
        dataset.accept(spark, plan)


def test_a_dataset_on_a_uri(spark, plan, tmp_path):
    plan = replace(plan, **{k: f"file://{getattr(plan, k)}" for k in ("plan_root", "cache_root", "dataset_root")}, raw_roots=[f"file://{r}" for r in plan.raw_roots])
    assert inputs.load_plan(inputs.write_plan(plan)) == plan
    _, events = build(spark, plan)
    assert events.count() == 5 and dataset.accept(spark, plan)["accepted"] and (tmp_path / "data/manifests/acceptance_report.json").exists()


def test_bad_events_are_counted_and_some_named(spark, plan, monkeypatch):
    monkeypatch.setattr(dataset, "EXAMPLES", 2)
    inputs.sync_inputs(plan)
    dataset.build_facts(spark, plan)
    with pytest.raises(dataset.NotAccepted, match="no event index"):
        dataset.accept(spark, plan)
    dataset.build_depth_feature(spark, plan)
    events = dataset.build_event_index(spark, plan)
    rows = events.withColumn("dataset_format", F.lit("another.v1")).collect()
    spark.createDataFrame(rows, events.schema).write.mode("overwrite").parquet(plan.path("events"))
    with pytest.raises(dataset.NotAccepted, match="event 0 .*event 1 .*5 bad events in all, the first 2 named"):
        dataset.accept(spark, plan)


def test_array_inputs_symbol_fallback_and_order(spark, plan, tmp_path):
    bare = [{k: v for k, v in b.items() if k != "symbol"} for b in BARS]
    array = tmp_path / "fetched/array.json"
    array.write_text(" \n " + json.dumps(bare))
    lines = put(tmp_path / "fetched/lines.jsonl", BARS[1])
    plan = replace(plan, binance_sources=[inputs.SourceSpec("array.json", str(array), "SNOWFALL"), inputs.SourceSpec("lines", lines)])
    inputs.sync_inputs(plan)
    dataset.build_facts(spark, plan)
    got = spark.read.parquet(plan.path("kline")).orderBy("ingest_seq").collect()
    assert [(r.ingest_seq, r.symbol, r.source_cache_name, r.close) for r in got] == [(0, "SNOWFALL", "array.json", 8.75), (1, "SNOWFALL", "array.json", 8.5), (2, "RAINFALL", "lines", 8.5)]
    bad = replace(plan, binance_sources=[inputs.SourceSpec("array.json", str(array))])
    inputs.sync_inputs(bad)
    with pytest.raises(Exception, match="without symbol"):
        dataset.build_facts(spark, bad)


def test_cached_lines_keep_their_order_over_many_splits(spark, tmp_path):
    n = 4000
    paths = [put(tmp_path / f"f{k}.jsonl", *({"k": k, "i": i} for i in range(n))) for k in range(3)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    try:
        df = tables.read_cached(spark, paths, "k bigint, i bigint", ("k", "i"))
        assert df.rdd.getNumPartitions() > 6
        rows = df.select("file", "block", "line_pos", "k", "i").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    rows.sort(key=lambda r: (r.file, r.block, r.line_pos))
    assert [(r.k, r.i) for r in rows] == [(k, i) for k in range(3) for i in range(n)]
    with pytest.raises(ValueError, match="share a name"):
        tables.read_cached(spark, [paths[0], f"/x/{os.path.basename(paths[0])}"], "k bigint")


def test_strict_reading(spark, plan, tmp_path):
    put(tmp_path / "raw/c/polymarket_book_top10.jsonl", {k: v for k, v in BOOKS[0].items() if k != "outcome"})
    with pytest.raises(Exception, match="outcome"):
        dataset.build_facts(spark, plan)


def test_numbering_in_ranges(spark):
    from ripplebook.operators.facts import with_sequence

    df = spark.range(5000).select((F.col("id") * 7919 % 1000).alias("t"), F.col("id").alias("k")).repartition(7)
    got = with_sequence(df, ["t", "k"], "n").orderBy("n").collect()
    assert [r.n for r in got] == list(range(5000)) and [(r.t, r.k) for r in got] == sorted((r.t, r.k) for r in got)
    assert with_sequence(df.filter("false"), ["t", "k"], "n").count() == 0


def test_scratch_tables_end_with_their_build_and_need_a_shared_folder(spark, plan):
    from ripplebook.sources import durable

    build(spark, plan)
    base = durable.shared_base(spark)
    assert not [x for x in os.listdir(base) if x.startswith("sequence")] or durable._kept

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        durable.shared_base(Session())


def test_jsonl_sink_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "b int, a string")
    sidecar = tables.write_jsonl(df, f"file://{tmp_path}/t")
    assert files.read_json(str(tmp_path / "t/_schema.json")) == sidecar and sidecar["fields"] == ["a", "b"]
    assert sidecar["part_files"] == sorted(p.name for p in (tmp_path / "t").glob("part-*"))
    assert sorted(map(tuple, tables.read_table(spark, str(tmp_path / "t"), "b int, a string").collect())) == [(1, None), (2, "x")]
