"""The command line over a small dataset."""

import json

import pytest

from ripplebook import cli
from tests.test_dataset import BARS, BOOKS, LABELS, put


def test_etl_commands(spark, tmp_path, capsys):
    put(tmp_path / "raw/pm_book_top10.jsonl", BOOKS[0])
    k, s = put(tmp_path / "k.jsonl", BARS[0]), put(tmp_path / "s.jsonl", LABELS[0] | {"status": "settled"})
    roots = [x for n in ("plan", "cache", "dataset") for x in (f"--{n}-root", str(tmp_path / n))]
    plan = cli.main(["etl", "plan", "--raw-root", str(tmp_path / "raw"), *roots, "--binance-source", f"name=k,url={k}", "--settlement-source", f"name=s,url={s}"])["plan"]
    step = lambda name, *more: cli.main(["etl", name, "--plan", plan, *more])
    assert step("sync-inputs") == {"available": 2, "missing": 0, "failed": 0}
    assert set(step("build-facts").values()) == {1, 2}
    assert step("build-depth-feature") == {"rows": 1} and step("build-event-index") == {"rows": 2}
    assert step("accept")["accepted"]
    step("export", "--export-root", str(tmp_path / "out"))
    assert (tmp_path / "out/manifests/acceptance_report.json").exists()
    assert spark.read.parquet(str(tmp_path / "out/tables/polymarket_settlement")).first().winner is True
    assert json.loads(capsys.readouterr().out.split("}\n")[-2] + "}")


def test_recorder_commands(tmp_path):
    path = str(tmp_path / "c.json")
    cli.main(["recorder", "init-config", "--path", path, "--raw-root", "r", "--state-root", str(tmp_path), "--symbol", "BTC", "--filter", "up"])
    config = json.load(open(path))
    assert (config["discovery"]["limit"], config["discovery"]["window_symbols"], config["discovery_interval_cycles"]) == (200, ["BTC"], 60)
    assert cli.main(["recorder", "status", "--state-root", str(tmp_path)])["cycle_count"] == 0


@pytest.mark.parametrize("bad", ["name=x", "url=y", "name=x,url=y,z=1", "x"])
def test_bad_sources(bad):
    with pytest.raises(ValueError):
        cli.inputs.parse_source_arg(bad)
