"""Discovery, cycles and the recording stream, over canned HTTP answers."""

import json
import time

import pytest

from ripplebook.streaming import discovery as d
from ripplebook.streaming import recorder as r

BOOK = json.dumps({"bids": [{"price": "0.48", "size": "1"}, {"price": "0.50", "size": "2"}, {"price": "0.49", "size": "3"}], "asks": [{"price": "0.53", "size": "1"}, {"price": "0.52", "size": "1"}, {"price": "0.9", "size": "0"}]})


def getter(answers):
    seen = []

    def get(url):
        seen.append(url)
        for part, a in answers.items():
            if part in url:
                return a.encode()
        raise OSError(url)

    get.seen = seen
    return get


def listing(**changes):
    m = {"conditionId": "c1", "slug": "btc-x", "question": "Q", "active": True, "closed": False, "acceptingOrders": True, "enableOrderBook": True, "outcomes": '["Yes","No"]', "clobTokenIds": '["t1","t2"]'}
    return json.dumps([m | changes])


def config(tmp_path, **changes):
    return d.RecorderConfig(str(tmp_path / "raw"), str(tmp_path / "state"), clob_base_url="http://b/", gamma_markets_url="http://g/markets", **changes)


def test_listing_and_top_n(tmp_path):
    c = config(tmp_path, top_n=2, discovery=d.Discovery(window_symbols=()))
    get = getter({"/markets?": listing(), "/book?": BOOK})
    rows, errors, state, polled = r.cycle(c, get, r.empty_state())
    assert get.seen[0] == "http://g/markets?active=true&closed=false&limit=24&order=volume24hr&ascending=false&accepting_orders=true"
    assert not errors and polled == 2 and [x["outcome"] for x in rows] == ["Yes", "No"] and state["next_ingest_seq"] == 2
    assert [x["price"] for x in rows[0]["bids"]] == [0.50, 0.49] and [x["price"] for x in rows[0]["asks"]] == [0.52, 0.53]
    for change in ({"closed": True}, {"active": False}, {"acceptingOrders": None}, {"enableOrderBook": "no"}):
        assert d.discover_listed(c, getter({"/markets?": listing(**change)})) == []


def test_series(tmp_path):
    now = int(time.time())
    end = (now // 300 + 1) * 300
    market = {"conditionId": "c9", "market_end_ms": end * 1000, "outcomes": '["Up","Down"]', "clobTokenIds": ["u", "n"], "question": "q"}
    payload = json.dumps({"events": [{"slug": f"btc-updown-5m-{end - 300}", "title": "Bitcoin", "markets": [market]}]})
    found = d.discover_windows(config(tmp_path), getter({"series_slug=btc": payload}), now)
    assert [(a.symbol, a.asset_id, a.outcome) for a in found] == [("BTC", "u", "YES"), ("BTC", "n", "NO")]
    assert d.parse_payload(json.loads(payload), None)[0]["symbol"] == "BTC"
    with pytest.raises(ValueError):
        d.discover_windows(config(tmp_path), getter({}), now)
    assert d.parse_payload({"events": [{"markets": [market | {"market_end_ms": (end + 60) * 1000, "slug": f"x-5m-{end}"}]}]}, "BTC") == []


def test_failed_assets_leave_until_discovery(tmp_path):
    c = config(tmp_path, discovery=d.Discovery(window_symbols=()))
    get = getter({"/markets?": listing(), "token_id=t1": BOOK})
    rows, errors, state, _ = r.cycle(c, get, r.empty_state())
    assert (len(rows), len(errors)) == (1, 1)
    rows, errors, state, _ = r.cycle(c, get, state)
    assert (len(rows), len(errors)) == (1, 0) and state["total_errors"] == 1 and state["last_error"]
    down = getter({"token_id=t1": BOOK})
    rows, errors, state, _ = r.cycle(c, down, state | {"cycle_count": 60})
    assert len(rows) == 1 and "discovery failed" in state["last_error"]
    with pytest.raises(OSError):
        r.cycle(c, down, r.empty_state())


def test_stream(spark, tmp_path):
    import os

    from ripplebook.plans import guard
    from ripplebook.sources import tables

    c = config(tmp_path, discovery=d.Discovery(enabled=False), explicit_assets=(d.Asset("S", "c", "a1", "YES"), d.Asset("S", "c", "a2", "NO")))
    path = str(tmp_path / "config.json")
    r.write_config(c, path)
    assert r.load_config(path) == c
    # the stream's reader runs in a process of its own and loads its fetcher from a file
    fake = tmp_path / "fake.py"
    fake.write_text(f"def get(url):\n    return {BOOK!r}.encode()\n")
    for n in (1, 2):
        assert r.run_once(spark, path, f"{fake}:get") == {"rows_written": 2, "errors": [], "assets_recorded": 2}
        assert r.status(c.state_root)["cycle_count"] == n
    raw = tables.read_raw_book(spark, [c.raw_root])
    assert [x.ingest_seq for x in raw.orderBy("ingest_seq").collect()] == [0, 1, 2, 3]
    assert guard.banned_fields(spark, c.raw_root) == [] and os.path.exists(os.path.join(c.state_root, "recorder_manifest.json"))


def test_a_spooled_cycle_is_given_again(tmp_path):
    """A batch asked for twice, as after a crash, has the same rows; numbers go on behind it."""
    c = config(tmp_path, discovery=d.Discovery(enabled=False), explicit_assets=(d.Asset("S", "c", "a1", "YES"),))
    path, fake = str(tmp_path / "config.json"), tmp_path / "fake.py"
    r.write_config(c, path)
    fake.write_text(f"def get(url):\n    return {BOOK!r}.encode()\n")
    reader = r.PollReader({"config": path, "fetcher": f"{fake}:get"})
    first, after = reader.read({"cycle": 0})
    first = list(first)
    again = r.PollReader({"config": path, "fetcher": f"{fake}:get"})
    assert list(again.read({"cycle": 0})[0]) == first == list(again.readBetweenOffsets({"cycle": 0}, after))
    assert [x[5] for x in again.read(after)[0]] == [1]
    again.commit({"cycle": 2})
    assert r.latest(c)["state"]["cycle_count"] == 2


def test_the_supervisor_starts_again_where_the_recorder_left_off(spark, tmp_path):
    """A fetcher that cannot be loaded fails the query; the next start goes on with the same spool."""
    c = config(tmp_path, poll_interval_ms=1, discovery=d.Discovery(enabled=False), explicit_assets=(d.Asset("S", "c", "a1", "YES"),))
    path, said = str(tmp_path / "config.json"), []
    r.write_config(c, path)
    assert r.supervise(spark, path, f"{tmp_path}/absent.py:get", delay_s=0.01, max_starts=2, say=said.append) == 2
    assert [x.split(":")[1] for x in said] == [" failed", " failed"]


def test_driver_and_native_field_readers_agree(spark):
    """The JSON readers of the discovery against those over columns, on one list of awkward values."""
    from pyspark.sql import functions as F

    from ripplebook.functions import json_fields as j

    values = ["x", "", " 1", "1_000", "12", "-3.5", "1e3", "+7", ".5", "5.", "true", "false", True, False, 0, 12, 2.5, -7, None, {}, [], "0x10", "1,5", "nan1"]
    rows = [(json.dumps({"v": v, "w": "spare"}),) for v in values]
    v = F.parse_json("t")
    text, number, flag = j.string_field(v, "v"), j.number_field(v, "v"), j.bool_field(v, "v")
    got = spark.createDataFrame(rows, "t string").select(text.alias("s"), number.alias("n"), flag.alias("b")).collect()
    want = [(d.text_of({"v": x}, "v"), d.number_of({"v": x}, "v"), d.flag_of({"v": x}, "v")) for x in values]
    assert [tuple(r) for r in got] == want
    texts = [["a", "b"], ["a", 1, None], [], '["p","q"]', '["p",2]', "[]", "no json", 5, None, {"a": "b"}]
    arrays = spark.createDataFrame([(json.dumps({"v": x}),) for x in texts], "t string").select(j.string_array(j.field(v, "v")).alias("a")).collect()
    assert [r.a for r in arrays] == [d.strings_of(x) for x in texts]
    times = [1_700_000_000_000, 1_700_000_000_000_000_000, "1700000000000", "2024-02-29T12:30:00Z", "2024-02-29 12:30:00.250", "2024-02-29T12:30:00+05:30", "-5"]
    ms = spark.createDataFrame([(json.dumps({"u": " ", "v": x}),) for x in times], "t string").select(j.timestamp_ms(v, "u", "v").alias("ms")).collect()
    assert [r.ms for r in ms] == [d.time_ms({"u": " ", "v": x}, "u", "v") for x in times]
