"""Command line: ``python -m ripplebook.cli etl ...`` and ``python -m ripplebook.cli recorder ...``."""

from __future__ import annotations

import argparse
import json

from ripplebook.plans import dataset
from ripplebook.session import local_session
from ripplebook.sources import inputs
from ripplebook.streaming import recorder
from ripplebook.streaming.discovery import Discovery, RecorderConfig


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="ripplebook")
    areas = top.add_subparsers(dest="area", required=True)
    etl = areas.add_parser("etl").add_subparsers(dest="command", required=True)
    plan = etl.add_parser("plan")
    plan.add_argument("--raw-root", action="append", required=True)
    for name in ("plan", "cache", "dataset"):
        plan.add_argument(f"--{name}-root", required=True)
    plan.add_argument("--reference-latency-ms", type=int, default=1000)
    plan.add_argument("--fail-closed-on-missing-reference", action="store_true")
    plan.add_argument("--binance-source", action="append", default=[], type=inputs.parse_source_arg)
    plan.add_argument("--settlement-source", action="append", default=[], type=inputs.parse_source_arg)
    for name in ("sync-inputs", "build-facts", "build-depth-feature", "build-event-index", "accept", "export"):
        p = etl.add_parser(name)
        p.add_argument("--plan", required=True)
        if name.startswith("build-"):
            p.add_argument("--layout", choices=("parquet", "jsonl"), default="parquet")
        if name == "export":
            p.add_argument("--export-root", required=True)
    rec = areas.add_parser("recorder").add_subparsers(dest="command", required=True)
    init = rec.add_parser("init-config")
    for name in ("path", "raw-root", "state-root"):
        init.add_argument(f"--{name}", required=True)
    init.add_argument("--poll-interval-ms", type=int, default=1000)
    init.add_argument("--max-assets-per-cycle", type=int, default=24)
    init.add_argument("--discovery-limit", type=int, default=200)
    init.add_argument("--discovery-interval-cycles", type=int, default=60)
    init.add_argument("--symbol", action="append", default=[])
    init.add_argument("--filter", action="append", default=[])
    run = rec.add_parser("run")
    run.add_argument("--config", required=True)
    run.add_argument("--once", action="store_true")
    run.add_argument("--max-cycles", type=int)
    keep = rec.add_parser("supervise")
    keep.add_argument("--config", required=True)
    keep.add_argument("--restart-delay-seconds", type=float, default=5.0)
    keep.add_argument("--max-starts", type=int)
    rec.add_parser("status").add_argument("--state-root", required=True)
    return top


def _etl(a: argparse.Namespace) -> dict:
    if a.command == "plan":
        plan = inputs.Plan(
            a.raw_root, a.plan_root, a.cache_root, a.dataset_root, a.reference_latency_ms, a.fail_closed_on_missing_reference, a.binance_source, a.settlement_source
        )
        return {"plan": inputs.write_plan(plan)}
    plan = inputs.load_plan(a.plan)
    if a.command == "sync-inputs":
        records = inputs.sync_inputs(plan)["records"]
        return {s: sum(r["status"] == s for r in records) for s in ("available", "missing", "failed")}
    if a.command == "export":
        dataset.export_dataset(plan, a.export_root)
        return {"exported": a.export_root}
    spark = local_session()
    if a.command == "build-facts":
        return dataset.build_facts(spark, plan, a.layout)["row_counts"]
    if a.command == "build-depth-feature":
        return {"rows": dataset.build_depth_feature(spark, plan, a.layout).count()}
    if a.command == "build-event-index":
        return {"rows": dataset.build_event_index(spark, plan, a.layout).count()}
    return dataset.accept(spark, plan)


def _recorder(a: argparse.Namespace) -> dict:
    if a.command == "init-config":
        d = Discovery(limit=a.discovery_limit, question_or_slug_contains_any=tuple(a.filter), **({"window_symbols": tuple(a.symbol)} if a.symbol else {}))
        config = RecorderConfig(a.raw_root, a.state_root, a.poll_interval_ms, a.discovery_interval_cycles, a.max_assets_per_cycle, discovery=d)
        recorder.write_config(config, a.path)
        return {"config": a.path}
    if a.command == "status":
        return recorder.status(a.state_root)
    spark = local_session()
    if a.command == "supervise":
        return {"starts": recorder.supervise(spark, a.config, delay_s=a.restart_delay_seconds, max_starts=a.max_starts)}
    if a.once or a.max_cycles is not None:
        return {"cycles": recorder.run_cycles(spark, a.config, 1 if a.once else a.max_cycles)}
    recorder.start(spark, a.config).awaitTermination()
    return {}


def main(argv: list[str] | None = None) -> dict:
    args = _parser().parse_args(argv)
    out = _etl(args) if args.area == "etl" else _recorder(args)
    print(json.dumps(out, indent=2, default=str))
    return out


if __name__ == "__main__":
    main()
