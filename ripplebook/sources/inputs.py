"""Plans, cache manifests and fetched inputs (driver side)."""

from __future__ import annotations

import re
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from ripplebook import schemas
from ripplebook.functions.hashing import sha256_bytes
from ripplebook.sources import files

Fetch = Callable[[str], bytes]


@dataclass(frozen=True)
class SourceSpec:
    name: str
    source_url: str
    symbol: str | None = None
    start_ts_ns: int = 0
    end_ts_ns: int = 0


@dataclass(frozen=True)
class Plan:
    raw_roots: list[str]
    plan_root: str
    cache_root: str
    dataset_root: str
    reference_latency_ms: int = 1000
    accept_fail_closed_on_missing_reference: bool = False
    binance_sources: list[SourceSpec] = field(default_factory=list)
    settlement_sources: list[SourceSpec] = field(default_factory=list)
    schema_version: int = schemas.VERSION
    dataset_format: str = schemas.PLAN

    def path(self, table: str) -> str:
        return files.join(self.dataset_root, schemas.TABLES[table])


def write_plan(plan: Plan) -> str:
    path = files.join(plan.plan_root, "pipeline_plan.json")
    files.write_json(path, asdict(plan))
    return path


def load_plan(path: str) -> Plan:
    raw = files.read_json(path)
    if raw.get("dataset_format") != schemas.PLAN:
        raise ValueError(f"unsupported plan format {raw.get('dataset_format')}, expected {schemas.PLAN}")
    sources = {k: [SourceSpec(**s) for s in raw.get(k, [])] for k in ("binance_sources", "settlement_sources")}
    known = {k: v for k, v in raw.items() if k in Plan.__dataclass_fields__}
    return Plan(**(known | sources))


def default_fetch(url: str) -> bytes:
    """A path on any file system that Spark reaches, or an http(s) GET that must succeed."""
    if not url:
        raise ValueError("empty source url")
    if url.startswith(("http://", "https://")):
        with urllib.request.urlopen(url, timeout=30) as r:
            return r.read()
    return files.read_bytes(url)


def safe_cache_name(name: str) -> str:
    clean = re.sub(r"[^A-Za-z0-9._-]", "_", name)
    return clean if clean.endswith((".json", ".jsonl")) else f"{clean}.jsonl"


def percent_encode(text: str) -> str:
    return urllib.parse.quote(text, safe="")


def sync_inputs(plan: Plan, fetch: Fetch = default_fetch) -> dict:
    """Fetches every source into the cache, bars first, and writes the cache manifest. A failing source is
    recorded and never ends the run."""
    records = []
    for group, specs in ((schemas.KLINE_GROUP, plan.binance_sources), (schemas.SETTLEMENT_GROUP, plan.settlement_sources)):
        names = [safe_cache_name(s.name) for s in specs]
        for spec, name in zip(specs, names, strict=True):
            if names.count(name) > 1:
                raise ValueError(f"sources of {group} share the cache file {name}")
            records.append(_sync_one(plan, fetch, group, spec, name))
    manifest = {"schema_version": schemas.VERSION, "dataset_format": schemas.CACHE_MANIFEST, "records": records}
    files.write_json(files.join(plan.cache_root, "cache_manifest.json"), manifest)
    return manifest


def _sync_one(plan: Plan, fetch: Fetch, group: str, spec: SourceSpec, name: str) -> dict:
    record = {"group": group, **asdict(spec), "cache_path": None, "missing_count": 1, "failure_reason": None, "response_hash": None}
    try:
        data = fetch(spec.source_url)
    except Exception as e:  # whatever a source does wrong is its record's failure
        return record | {"status": "failed", "failure_reason": str(e)}
    if not data:
        return record | {"status": "missing", "failure_reason": "empty response"}
    path = files.join(plan.cache_root, group, name)
    files.write_bytes(path, data)
    return record | {"status": "available", "cache_path": path, "missing_count": 0, "response_hash": sha256_bytes(data)}


def read_cache_manifest(plan: Plan) -> dict:
    path = files.join(plan.cache_root, "cache_manifest.json")
    if not files.exists(path):
        return {"schema_version": schemas.VERSION, "dataset_format": schemas.CACHE_MANIFEST, "records": []}
    return files.read_json(path)


def parse_source_arg(text: str) -> SourceSpec:
    """``name=...,url=...[,symbol=...,start=...,end=...]``."""
    got: dict[str, str] = {}
    for part in text.split(","):
        k, sep, v = part.partition("=")
        if not sep or k not in ("name", "url", "symbol", "start", "end"):
            raise ValueError(f"bad source argument: {part}")
        got[k] = v
    for k in ("name", "url"):
        if not got.get(k):
            raise ValueError(f"source argument lacks {k}")
    return SourceSpec(got["name"], got["url"], got.get("symbol"), int(got.get("start", 0)), int(got.get("end", 0)))
