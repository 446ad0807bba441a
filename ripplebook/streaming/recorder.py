"""The recorder as a streaming source and query.

A micro-batch is one cycle: choose assets, poll each book, emit the rows. A poll cannot be repeated after
a crash, so the reader spools every cycle's rows and state to disk under its number before handing them
out; a batch that is asked for again comes from the spool, and sequence numbers go on without gaps. Spool, state and
configuration lie on the driver's file system (the reader's process has no JVM); rows go to any that Spark reaches.
"""

from __future__ import annotations

import importlib
import importlib.util
import json
import os
import time
import uuid
from collections.abc import Iterator
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from ripplebook import schemas
from ripplebook.functions.hashing import existing_hash
from ripplebook.sources import files
from ripplebook.streaming.discovery import Asset, Get, RecorderConfig, discover, fetch_book, merge

FORMAT = "order_book_poll"
SCHEMA = f"{schemas.RAW_BOOK}, cycle bigint, cycle_start_ts_ns bigint"


def empty_state() -> dict:
    return {
        "schema_version": schemas.VERSION, "dataset_format": schemas.RECORDER_STATE, "next_ingest_seq": 0, "cycle_count": 0, "total_rows": 0,
        "total_errors": 0, "last_cycle_start_ts_ns": None, "last_cycle_end_ts_ns": None, "last_error": None, "last_assets": [],
    }


def due(config: RecorderConfig, state: dict) -> bool:
    """Whether this cycle discovers anew."""
    every = config.discovery_interval_cycles
    return config.discovery.enabled and (not state["last_assets"] or every == 0 or state["cycle_count"] % every == 0)


def _write_local(path: str, value) -> None:
    """Indented JSON, moved into place whole."""
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    temporary = f"{path}.{uuid.uuid4().hex}"
    with open(temporary, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2)
    os.replace(temporary, path)


def _read_local(path: str):
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def refreshed(config: RecorderConfig, get: Get, known: list[dict], now_s: int) -> tuple[list[dict], str | None]:
    """(the asset list after a discovery, what went wrong). With nothing known a failure is raised."""
    try:
        return [asdict(a) for a in merge(config.explicit_assets, discover(config, get, now_s))], None
    except Exception as e:
        if not known:
            raise
        return known, f"kept {len(known)} known assets, as discovery failed: {e}"


def poll(config: RecorderConfig, get: Get, assets: list[Asset], first_seq: int, clock) -> tuple[list[dict], dict[str, str]]:
    """(a row an asset that answers, numbered from ``first_seq``; what went wrong by asset id). One failure leaves the others."""
    rows, wrong = [], {}
    for a in assets:
        try:
            rows.append(fetch_book(config, get, a, first_seq + len(rows), clock))
        except Exception as e:
            wrong[a.asset_id] = f"{a.symbol} {a.asset_id}: {e}"
    return rows, wrong


def cycle(config: RecorderConfig, get: Get, state: dict, clock=time.time_ns) -> tuple[list[dict], list[str], dict, int]:
    """(rows, errors, next state, assets polled). A failed discovery goes on with the last assets if there are any;
    assets whose book fails are left out until the next discovery."""
    began, known, complaint = clock(), state["last_assets"], None
    if due(config, state):
        known, complaint = refreshed(config, get, known, began // 1_000_000_000)
    listed = [Asset(**a) for a in known] if config.discovery.enabled else list(config.explicit_assets)
    polled = listed[: config.max_assets_per_cycle]
    rows, wrong = poll(config, get, polled, state["next_ingest_seq"], clock)
    errors = list(wrong.values())
    after = state | {
        "last_assets": [a for a in known if a["asset_id"] not in wrong] if config.discovery.enabled else known,
        "next_ingest_seq": state["next_ingest_seq"] + len(rows), "cycle_count": state["cycle_count"] + 1,
        "total_rows": state["total_rows"] + len(rows), "total_errors": state["total_errors"] + len(errors) + (complaint is not None),
        "last_error": ([state["last_error"]] + [complaint] * (complaint is not None) + errors)[-1],
        "last_cycle_start_ts_ns": began, "last_cycle_end_ts_ns": clock(),
    }
    return rows, errors, after, len(polled)


def http_get(url: str) -> bytes:
    """A GET that must succeed."""
    import urllib.request

    with urllib.request.urlopen(url, timeout=10) as r:
        return r.read()


def _load(name: str) -> Get:
    """``module:function`` or ``/path/to/file.py:function``."""
    module, _, attribute = name.rpartition(":")
    if not module.endswith(".py"):
        return getattr(importlib.import_module(module), attribute)
    spec = importlib.util.spec_from_file_location("recorder_fetcher", module)
    loaded = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(loaded)
    return getattr(loaded, attribute)


class PollReader(SimpleDataSourceStreamReader):
    def __init__(self, options: dict):
        self.config = load_config(options["config"])
        self.get = _load(options.get("fetcher", "ripplebook.streaming.recorder:http_get"))
        self.spool = os.path.join(self.config.state_root, "spool")

    def initialOffset(self) -> dict:
        return {"cycle": 0}

    def _path(self, number: int) -> str:
        return os.path.join(self.spool, f"{number:012d}.json")

    def _spooled(self, number: int) -> dict:
        return _read_local(self._path(number))

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        number = start["cycle"]
        if not os.path.exists(self._path(number)):
            before = self._spooled(number - 1)["state"] if number else empty_state()
            rows, errors, state, polled = cycle(self.config, self.get, before)
            _write_local(self._path(number), {"rows": rows, "errors": errors, "state": state, "assets_recorded": polled})
        return self._rows(number), {"cycle": number + 1}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        for number in range(start["cycle"], end["cycle"]):
            yield from self._rows(number)

    def _rows(self, number: int) -> Iterator[tuple]:
        """The rows of a spooled cycle; an iterator over a list, as Spark copies it."""
        batch = self._spooled(number)
        levels = lambda side: [(x["price"], x["size"]) for x in side]
        names = ("symbol", "condition_id", "asset_id", "outcome", "local_recv_ts_ns", "ingest_seq")
        start = batch["state"]["last_cycle_start_ts_ns"]
        return iter([(*[r[n] for n in names], levels(r["bids"]), levels(r["asks"]), number, start) for r in batch["rows"]])

    def commit(self, end: dict) -> None:
        """Spooled cycles before the last are no longer needed (the last carries the state)."""
        for name in os.listdir(self.spool) if os.path.isdir(self.spool) else ():
            if name[:12].isdigit() and int(name[:12]) < end["cycle"] - 1:
                os.remove(os.path.join(self.spool, name))


class PollSource(DataSource):
    """``spark.readStream.format("order_book_poll").option("config", path)``."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def simpleStreamReader(self, schema) -> SimpleDataSourceStreamReader:
        return PollReader(self.options)


def output_path(raw_root: str, start_ts_ns: int, number: int) -> str:
    """A file of its own for each cycle (streams read new files, not appended lines), by the hour of its start."""
    hour = start_ts_ns // 1_000_000_000 // 3600
    return files.join(raw_root, "polymarket_book_top10", f"hour_bucket={hour}", f"cycle={number}", "polymarket_book_top10.jsonl")


def _write_cycle(config: RecorderConfig, batch: DataFrame) -> None:
    """One file a cycle, written whole; writing a cycle again gives the same file. A cycle has at most max_assets rows."""
    by: dict[tuple[int, int], list[dict]] = {}
    for r in batch.orderBy("cycle", "ingest_seq").toLocalIterator():
        row = r.asDict(recursive=True)
        by.setdefault((row.pop("cycle"), row.pop("cycle_start_ts_ns")), []).append(row)
    last = None
    for (number, start), rows in by.items():
        last = output_path(config.raw_root, start, number)
        files.write_bytes(last, "".join(json.dumps(x, separators=(",", ":")) + "\n" for x in rows).encode())
    done = latest(config)
    if done:
        _write_local(state_path(config), done["state"])
        _write_local(
            os.path.join(config.state_root, "recorder_manifest.json"),
            {
                "schema_version": schemas.VERSION, "dataset_format": schemas.RECORDER_MANIFEST, "raw_root": config.raw_root, "state_root": config.state_root,
                "state_hash": existing_hash(f"file://{os.path.abspath(state_path(config))}"), "last_output_path": last, "last_output_hash": existing_hash(last) if last else None,
                "last_cycle_rows": len(done["rows"]), "last_cycle_errors": len(done["errors"]),
            },
        )


def state_path(config: RecorderConfig) -> str:
    return os.path.join(config.state_root, "recorder_state.json")


def latest(config: RecorderConfig) -> dict | None:
    """The last spooled cycle: rows, errors, state, assets_recorded."""
    spool = os.path.join(config.state_root, "spool")
    names = sorted(n for n in os.listdir(spool) if n.endswith(".json")) if os.path.isdir(spool) else []
    if not names:
        return None
    return _read_local(os.path.join(spool, names[-1]))


def write_config(config: RecorderConfig, path: str) -> None:
    _write_local(path, config.to_json())


def load_config(path: str) -> RecorderConfig:
    return RecorderConfig.from_json(_read_local(path))


def status(state_root: str) -> dict:
    path = os.path.join(state_root, "recorder_state.json")
    return _read_local(path) if os.path.exists(path) else empty_state()


def stream(spark: SparkSession, config_path: str, fetcher: str | None = None) -> DataFrame:
    """The polled rows as a streaming frame."""
    spark.dataSource.register(PollSource)
    reader = spark.readStream.format(FORMAT).option("config", config_path)
    return (reader.option("fetcher", fetcher) if fetcher else reader).load()


def start(spark: SparkSession, config_path: str, fetcher: str | None = None, once: bool = False):
    """The streaming query that records; ``once`` ends after one cycle."""
    config = load_config(config_path)
    writer = stream(spark, config_path, fetcher).writeStream.option("checkpointLocation", os.path.join(config.state_root, "checkpoint"))
    writer = writer.foreachBatch(lambda batch, _: _write_cycle(config, batch))
    trigger = {"availableNow": True} if once else {"processingTime": f"{config.poll_interval_ms} milliseconds"}
    return writer.trigger(**trigger).start()


def run_once(spark: SparkSession, config_path: str, fetcher: str | None = None) -> dict:
    """One cycle; its report: rows_written, errors, assets_recorded."""
    query = start(spark, config_path, fetcher, once=True)
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    done = latest(load_config(config_path))
    return {"rows_written": len(done["rows"]), "errors": done["errors"], "assets_recorded": done["assets_recorded"]}


def run_cycles(spark: SparkSession, config_path: str, cycles: int, fetcher: str | None = None) -> list[dict]:
    """So many cycles, a poll interval after each."""
    out = []
    for _ in range(cycles):
        out.append(run_once(spark, config_path, fetcher))
        time.sleep(load_config(config_path).poll_interval_ms / 1000)
    return out


def supervise(spark: SparkSession, config_path: str, fetcher: str | None = None, *, delay_s: float = 5.0, max_starts: int | None = None, say=print) -> int:
    """Keeps a recording going: starts it anew, ``delay_s`` after it has ended for whatever reason, from where its checkpoint and
    spool left off. Returns how often it was started, once that is ``max_starts``."""
    starts = 0
    while max_starts is None or starts < max_starts:
        if starts:
            time.sleep(delay_s)
        starts += 1
        try:
            start(spark, config_path, fetcher).awaitTermination()
            say(f"recorder, start {starts}: ended")
        except Exception as e:  # a query's failure ends this start only
            say(f"recorder, start {starts}: failed: {str(e).splitlines()[0] if str(e) else type(e).__name__}")
    return starts
