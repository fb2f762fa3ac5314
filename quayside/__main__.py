"""Command line: the scheduled and event-driven runs as commands.

    python -m quayside ingest   --lake ROOT --landing DIR [--loaded-at TS] [--batch-id ID]
    python -m quayside stream   --lake ROOT --landing DIR --checkpoint DIR [--gold] [--processing-time T]
    python -m quayside run-gold --lake ROOT --as-of YYYY-MM-DD [--run-ts TS] [--all-eight]
    python -m quayside report   --lake ROOT NAME   (destination_counts, quarantine_by_reason, ...)

A scheduler runs ``run-gold`` once a day after the day's files have landed (the
reference's 07:00 UTC call); ``--run-ts`` defaults to the current UTC time.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from quayside.plans.gold_run import run_gold
from quayside.plans.ingest import ingest_csv
from quayside.plans.views import REPORT_SQL, register_views, report
from quayside.session import Lakehouse, build_session
from quayside.sources.raw_table import read_rejects
from quayside.streaming.ingest_stream import start_ingest_stream


def _now() -> str:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None).isoformat(sep=" ", timespec="seconds")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="quayside")
    sub = ap.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("ingest", help="land every .csv under a folder in raw (one batch)")
    p.add_argument("--lake", required=True)
    p.add_argument("--landing", required=True)
    p.add_argument("--loaded-at", default=None, help="load timestamp; default: now, or for a batch id landed before, its time")
    p.add_argument("--batch-id", default=None, help="re-use to replace an earlier batch")
    p.add_argument("--strict", action="store_true", help="fail on files with unknown columns")

    p = sub.add_parser("stream", help="land new .csv files (availableNow), optionally run gold")
    p.add_argument("--lake", required=True)
    p.add_argument("--landing", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--gold", action="store_true", help="run gold for every load day a batch touched")
    p.add_argument("--processing-time", default=None, help="run continuously with this trigger, e.g. '5 minutes'")
    p.add_argument("--max-files-per-trigger", type=int, default=None)

    p = sub.add_parser("run-gold", help="stage one load day; write gold, quarantine, check log")
    p.add_argument("--lake", required=True)
    p.add_argument("--as-of", required=True)
    p.add_argument("--run-ts", default=None)
    p.add_argument("--all-eight", action="store_true", help="log all eight row checks")

    p = sub.add_parser("report", help="print a verification report")
    p.add_argument("--lake", required=True)
    p.add_argument("name", choices=sorted(REPORT_SQL))
    p.add_argument("--out", default=None, help="write the report there (JSON lines) instead of printing it")

    args = ap.parse_args(argv)
    spark = build_session(app_name=f"quayside-{args.cmd}")
    lake = Lakehouse(args.lake.rstrip("/"))

    if args.cmd == "ingest":
        res = ingest_csv(spark, args.landing, lake.raw, args.loaded_at, batch_id=args.batch_id, strict=args.strict, rejects_path=lake.landing_rejects, ledger_path=lake.landed_files, metrics_path=lake.run_metrics)
        out = {
            "batch_id": res.batch_id,
            "files": res.files,
            "rejected": res.rejected,
            "skipped": res.skipped,
            "rejects_table": lake.landing_rejects,
            "rows_landed": res.rows_landed,
            "load_dates": [d.isoformat() for d in res.load_dates],
        }
    elif args.cmd == "stream":
        q = start_ingest_stream(
            spark,
            args.landing,
            lake,
            args.checkpoint,
            available_now=args.processing_time is None,
            processing_time=args.processing_time,
            run_gold_after=args.gold,
            max_files_per_trigger=args.max_files_per_trigger,
        )
        q.awaitTermination()
        rejects = read_rejects(spark, lake.landing_rejects)
        out = {"last_progress": q.lastProgress, "rejected_files": rejects.count(), "rejects_table": lake.landing_rejects}
    elif args.cmd == "run-gold":
        res = run_gold(spark, lake, args.as_of, args.run_ts or _now(), all_eight=args.all_eight)
        out = {
            "as_of": res.as_of.isoformat(),
            "staged_rows": res.staged_rows,
            "gold_appended": res.gold_appended,
            "quarantined": res.quarantined,
        }
    else:
        register_views(spark, lake)
        rows = report(spark, args.name)
        if args.out:
            rows.write.mode("overwrite").json(args.out)
        else:
            for row in rows.toLocalIterator():  # every row, a partition at a time
                print(json.dumps(row.asDict(), default=str))
        out = None

    if out is not None:
        print(json.dumps(out, default=str))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
