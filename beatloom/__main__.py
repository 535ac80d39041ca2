"""Command line: run one stage or all of them, check a run, or look at a record's windows."""

from __future__ import annotations

import argparse
import sys
import uuid
from datetime import UTC, datetime

from beatloom import constants as K
from beatloom import schemas
from beatloom.plans.gates import GATES
from beatloom.plans.run import Run, run_all
from beatloom.session import build_session
from beatloom.sinks.tables import preview

STAGES = ("run", "ingest", "process", "aggregate")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="beatloom", description=__doc__)
    parser.add_argument("command", choices=[*STAGES, "check", "preview"])
    parser.add_argument("--root", required=True, help="where the layer tables live")
    parser.add_argument("--run-date", default=datetime.now(UTC).strftime("%Y-%m-%d"))
    parser.add_argument("--run-id", help="default: the run date and a random suffix")
    parser.add_argument("--waveforms", help="Parquet path of decoded waveforms")
    parser.add_argument("--ids", help="comma-separated records; wins over --range")
    parser.add_argument("--range", help="inclusive range of numbers, such as 7-12")
    parser.add_argument("--limit", help="cut the requested records; for preview, rows to show")
    parser.add_argument("--slice-seconds")
    parser.add_argument("--overwrite", action="store_true")
    parser.add_argument("--generations", action="store_true", help="modelling tables are published together")
    parser.add_argument("--gate", choices=GATES, action="append", help="default: all gates")
    parser.add_argument("--record-id", help="record to preview")
    args = parser.parse_args(argv)
    args.run_id = args.run_id or f"{args.run_date}_{uuid.uuid4().hex[:8]}"
    if args.command in ("run", "ingest") and not args.waveforms:
        parser.error("--waveforms is needed to ingest")
    if args.command == "preview" and not args.record_id:
        parser.error("--record-id is needed to preview")
    return args


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    spark = build_session()
    try:
        if args.command == "preview":
            run = Run(spark, args.root, args.run_id, args.run_date, generations=args.generations)
            windows = run.modelling(K.WINDOW_FEATURES_ML)
            preview(windows, args.run_id, args.record_id, int(args.limit or 3)).show(truncate=False)
            return 0
        if args.command == "check":
            run = Run(spark, args.root, args.run_id, args.run_date, generations=args.generations)
            violations = run.check(args.gate or GATES)
            violations.show(truncate=False)
            return int(not violations.isEmpty())
        selection = {"ids": args.ids, "range": args.range, "limit": args.limit}
        where = (spark, args.root, args.run_id, args.run_date)
        if args.command == "run":
            waveforms = spark.read.schema(schemas.WAVEFORMS).parquet(args.waveforms)
            results = run_all(
                *where, waveforms, overwrite=args.overwrite, slice_seconds=args.slice_seconds,
                generations=args.generations, **selection,
            )
            if results[-1].service == K.AGGREGATION:
                violations = Run(*where, generations=args.generations).check()
                if not violations.isEmpty():
                    violations.show(truncate=False)
                    return 1
        else:
            run = Run(*where, args.overwrite, generations=args.generations, **selection)
            if args.command == "ingest":
                waveforms = spark.read.schema(schemas.WAVEFORMS).parquet(args.waveforms)
                results = [run.ingest(waveforms, args.slice_seconds)]
            else:
                results = [getattr(run, args.command)()]
    except (ValueError, LookupError, RuntimeError) as error:
        print(f"run {args.run_id}: {type(error).__name__}: {error}", file=sys.stderr)
        return 1
    for result in results:
        print(f"run {args.run_id}: {result}")
    return int(any(r.records_failed for r in results))


if __name__ == "__main__":
    sys.exit(main())
