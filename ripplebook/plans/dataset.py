"""Builds of a dataset from a plan: facts, depth features, event index, acceptance, export."""

from __future__ import annotations

import hashlib
import json
import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ripplebook import schemas
from ripplebook.functions.hashing import existing_hash, table_digest
from ripplebook.operators import events, facts, features
from ripplebook.plans import guard
from ripplebook.sources import durable, files, tables
from ripplebook.sources.inputs import Plan, read_cache_manifest

#: Bad events that a report names one by one; it counts them all.
EXAMPLES = 100


def _read(spark: SparkSession, plan: Plan, name: str) -> DataFrame:
    return tables.read_table(spark, plan.path(name), schemas.TABLE_COLUMNS[name])


def _write(spark: SparkSession, plan: Plan, name: str, df: DataFrame, order: list[str], layout: str = "parquet") -> dict:
    """Writes a table in order, as Parquet or JSON lines, and returns its row count and digest, read back from what was written."""
    if layout == "jsonl":
        tables.write_jsonl(df.orderBy(*order), plan.path(name))
    else:
        tables.write_table(df.orderBy(*order), plan.path(name))
    return table_digest(_read(spark, plan, name))


def _records(manifest: dict, group: str) -> list[dict]:
    """Available records of a group; files of others are never opened."""
    return [r for r in manifest["records"] if r["group"] == group and r["status"] == "available" and r["cache_path"]]


def cached_rows(spark: SparkSession, records: list[dict], schema: str, required: tuple[str, ...]) -> DataFrame:
    """Rows of all records with record_idx, block, line_pos, source_cache_name and record_symbol: one read, joined to the records by file name."""
    known = [(posixpath.basename(r["cache_path"]), i, r["name"], r["symbol"]) for i, r in enumerate(records)]
    known = spark.createDataFrame(known, "file string, record_idx int, source_cache_name string, record_symbol string")
    return tables.read_cached(spark, [r["cache_path"] for r in records], schema, required).join(known, "file").drop("file")


def _group_hash(manifest: dict, group: str) -> str:
    rows = [r for r in manifest["records"] if r["group"] == group]
    return hashlib.sha256(json.dumps(rows, separators=(",", ":")).encode()).hexdigest()


def _base_manifest(plan: Plan) -> dict:
    return {
        "schema_version": schemas.VERSION, "dataset_format": schemas.DATASET, "raw_roots": plan.raw_roots, "plan_root": plan.plan_root,
        "cache_root": plan.cache_root, "dataset_root": plan.dataset_root, "binance_cache_manifest_hash": None, "settlement_cache_manifest_hash": None,
        "fact_table_hash": None, "depth_feature_hash": None, "event_index_hash": None, "contains_strategy_fields": False,
        "contains_settlement_in_event_stream": False,
    }


def read_dataset_manifest(plan: Plan) -> dict:
    path = files.join(plan.dataset_root, schemas.DATASET_MANIFEST)
    return files.read_json(path) if files.exists(path) else _base_manifest(plan)


def _write_manifest(plan: Plan, manifest: dict) -> None:
    files.write_json(files.join(plan.dataset_root, schemas.DATASET_MANIFEST), manifest)


def build_facts(spark: SparkSession, plan: Plan, layout: str = "parquet") -> dict:
    """Writes the five fact tables (``layout`` parquet or jsonl), their report and a fresh dataset manifest; returns the report."""
    cache = read_cache_manifest(plan)
    digests = {}
    write = lambda name, df, order: _write(spark, plan, name, df, order, layout)
    book = facts.book_facts(tables.read_raw_book(spark, plan.raw_roots))
    digests["book"] = write("book", book, ["local_recv_ts_ns", "ingest_seq", "primary_key", "raw_row_hash"])
    dim = facts.market_dim(_read(spark, plan, "book"))  # from what was written: raw files are parsed once
    digests["market_dim"] = write("market_dim", dim, ["condition_id", "asset_id", "outcome"])
    with durable.scope():
        bars = cached_rows(spark, _records(cache, schemas.KLINE_GROUP), schemas.RAW_KLINE, schemas.REQUIRED_KLINE)
        klines = facts.kline_reference(bars, plan.reference_latency_ms)
        digests["kline"] = write("kline", klines, ["synthetic_local_recv_ts_ns", "ingest_seq", "primary_key"])
    raw = cached_rows(spark, _records(cache, schemas.SETTLEMENT_GROUP), schemas.RAW_SETTLEMENT, schemas.REQUIRED_SETTLEMENT)
    labels = facts.settlements(tables.require_domain(raw, "status", schemas.SETTLEMENT_STATES))
    digests["settlement"] = write("settlement", labels, ["primary_key", "row_hash"])
    rows = [tuple(r.get(f.split()[0]) for f in schemas.CACHE_RECORD.split(", ")) for r in cache["records"]]
    available = facts.input_availability(spark.createDataFrame(rows, schemas.CACHE_RECORD))
    digests["availability"] = write("availability", available, ["group", "name"])
    hashes = {schemas.TABLES[k]: v["table_hash"] for k, v in sorted(digests.items())}
    report = {
        "schema_version": schemas.VERSION, "dataset_format": schemas.MATERIALIZATION, "raw_roots": plan.raw_roots, "plan_root": plan.plan_root,
        "cache_root": plan.cache_root, "dataset_root": plan.dataset_root, "table_hashes": hashes,
        "row_counts": {schemas.TABLES[k]: v["row_count"] for k, v in sorted(digests.items())},
        "cache_manifest_hash": existing_hash(files.join(plan.cache_root, "cache_manifest.json")),
        "contains_strategy_fields": bool(guard.banned_fields(spark, plan.dataset_root)), "contains_settlement_in_event_stream": False,
    }
    files.write_json(files.join(plan.dataset_root, schemas.MATERIALIZATION_REPORT), report)
    manifest = _base_manifest(plan) | {
        "binance_cache_manifest_hash": _group_hash(cache, schemas.KLINE_GROUP),
        "settlement_cache_manifest_hash": _group_hash(cache, schemas.SETTLEMENT_GROUP),
        "fact_table_hash": hashlib.sha256(json.dumps(hashes).encode()).hexdigest(),
        "contains_strategy_fields": report["contains_strategy_fields"],
    }
    _write_manifest(plan, manifest)
    return report


def build_depth_feature(spark: SparkSession, plan: Plan, layout: str = "parquet") -> DataFrame:
    """Reads the book table alone and writes its depth features."""
    depth = features.depth_feature(_read(spark, plan, "book"))
    digest = _write(spark, plan, "depth", depth, ["local_recv_ts_ns", "ingest_seq", "primary_key", "row_hash"], layout)
    _write_manifest(plan, read_dataset_manifest(plan) | {"depth_feature_hash": digest["table_hash"]})
    return _read(spark, plan, "depth")


def build_event_index(spark: SparkSession, plan: Plan, layout: str = "parquet") -> DataFrame:
    with durable.scope():
        index = events.event_index(_read(spark, plan, "depth"), _read(spark, plan, "kline"))
        digest = _write(spark, plan, "events", index, ["global_event_seq"], layout)
    out = _read(spark, plan, "events")
    leak = not guard.invalid_events(out).isEmpty()
    _write_manifest(plan, read_dataset_manifest(plan) | {"event_index_hash": digest["table_hash"], "contains_settlement_in_event_stream": leak})
    return out


class NotAccepted(RuntimeError):
    """A dataset failed acceptance; the report has been written."""


def _event_faults(spark: SparkSession, plan: Plan) -> list[str]:
    """What is wrong with the event index: a line for each of the first bad events, and how many there are."""
    if not files.exists(plan.path("events")):
        return ["the dataset has no event index"]
    bad = guard.invalid_events(_read(spark, plan, "events"))
    n = bad.count()
    first = bad.select("global_event_seq").orderBy("global_event_seq").limit(EXAMPLES).collect() if n else []
    out = [f"event {r[0]} is of a settlement or of another format" for r in first]
    return out + ([f"{n} bad events in all, the first {EXAMPLES} named"] if n > EXAMPLES else [])


def _reference_faults(spark: SparkSession, plan: Plan, require_reference: bool) -> list[str]:
    """Bar inputs that the plan or the caller insists on and that are absent (a line a source of the plan)."""
    known = files.exists(plan.path("availability"))
    out = []
    if plan.accept_fail_closed_on_missing_reference and known:
        gone = guard.missing_references(_read(spark, plan, "availability")).orderBy("name")
        out += [f"reference bars '{r['name']}' are {r['status']}" for r in gone.collect()]
    if require_reference and (not known or _read(spark, plan, "availability").filter(F.col("group") == schemas.KLINE_GROUP).isEmpty()):
        out.append("the dataset has no reference bars")
    return out


def accept(spark: SparkSession, plan: Plan, *, require_reference: bool = False) -> dict:
    """Checks a dataset and writes the report, then raises if anything is wrong.

    ``require_reference`` also refuses datasets that have no bar input at all (an extension).
    """
    fields = [f"{path} holds the strategy field '{field}'" for path, field in guard.banned_fields(spark, plan.dataset_root)]
    found = fields + _event_faults(spark, plan) + _reference_faults(spark, plan, require_reference)
    report = {"schema_version": schemas.VERSION, "dataset_format": schemas.ACCEPTANCE, "accepted": not found, "violations": found}
    files.write_json(files.join(plan.dataset_root, schemas.ACCEPTANCE_REPORT), report)
    if found:
        raise NotAccepted("not accepted: " + "; ".join(found))
    return report


def export_dataset(plan: Plan, export_root: str) -> None:
    """Copies an accepted dataset, between file systems too; the target is replaced. Refuses targets that overlap the dataset,
    and datasets that acceptance has not passed."""
    source, target = (f"{files.qualified(p)}/" for p in (plan.dataset_root, export_root))
    if source.startswith(target) or target.startswith(source):
        raise ValueError("export and dataset folders overlap")
    report = files.join(plan.dataset_root, schemas.ACCEPTANCE_REPORT)
    if not files.exists(report) or not files.read_json(report).get("accepted", False):
        raise NotAccepted("dataset has not been accepted")
    files.copy_folder(plan.dataset_root, export_root)


def load_backtest_inputs(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four tables that research reads, in either physical format: events, depth, klines, settlements."""
    names = {"events": "events", "depth": "depth", "klines": "kline", "settlements": "settlement"}
    return {k: tables.read_table(spark, files.join(root, schemas.TABLES[t]), schemas.TABLE_COLUMNS[t]) for k, t in names.items()}
