"""Command line: landing a source, one batch run, or the streaming jobs.

    python -m scoreline.cli land --source snapshot --input DIR --landing L --fetched-at 2026-06-27T00:00:00+00:00
    python -m scoreline.cli run --landing L --tables T --batch-id 3 --as-of 2026-06-27T00:00:00 [--events E]
    python -m scoreline.cli stream-events --input E --tables T [--continuous]
    python -m scoreline.cli stream-standings --input M --tables T [--continuous]

Checkpoints live under the tables root, which must be a shared folder on a
cluster. The session is whatever ``getOrCreate`` returns (cluster settings win).
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from scoreline.session import get_spark
from scoreline.schemas import MATCHES_STREAM
from scoreline.sources import registry
from scoreline.sources.io import Tables


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="scoreline")
    sub = ap.add_subparsers(dest="cmd", required=True)
    n = sub.add_parser("land", help="read a source and land its entities as one batch")
    n.add_argument("--source", default=registry.DEFAULT_SOURCE, choices=registry.names())
    n.add_argument("--input", required=True, help="folder of the source's tables")
    n.add_argument("--landing", required=True)
    n.add_argument("--fetched-at", required=True, help="batch stamp, ISO-8601 with offset")
    r = sub.add_parser("run", help="landing -> bronze -> silver -> SCD2 -> gold -> checks")
    r.add_argument("--landing", required=True)
    r.add_argument("--tables", required=True)
    r.add_argument("--batch-id", type=int, required=True)
    r.add_argument("--as-of", required=True, help="SCD2 stamp, ISO-8601 without offset")
    r.add_argument("--events")
    r.add_argument("--no-enforce", action="store_true")
    r.add_argument("--keep-snapshots", type=int, help="snapshots of a table that stay (all if not given)")
    e = sub.add_parser("stream-events", help="event files -> bronze -> silver -> top-scorer change log")
    e.add_argument("--input", required=True)
    e.add_argument("--tables", required=True)
    e.add_argument("--continuous", action="store_true")
    e.add_argument("--max-files-per-trigger", type=int)
    s = sub.add_parser("stream-standings", help="match files -> incremental silver -> SCD2 standings")
    s.add_argument("--input", required=True)
    s.add_argument("--tables", required=True)
    s.add_argument("--continuous", action="store_true")
    s.add_argument("--max-files-per-trigger", type=int)
    s.add_argument("--only-live", action="store_true", help="only land rows while no match is open")
    for p in (e, s):
        p.add_argument("--every", default="5 minutes", help="interval of a continuous job")
    a = ap.parse_args(argv)

    spark = get_spark()
    if a.cmd == "land":
        registry.land(spark, a.source, a.input, a.landing, a.fetched_at)
        print(json.dumps({"landed": a.landing, "source": a.source, "fetched_at": a.fetched_at}))
        return 0
    tables = Tables(spark, a.tables)
    if a.cmd == "run":
        from scoreline.plans import medallion

        rep = medallion.run(
            spark,
            tables,
            a.landing,
            a.batch_id,
            dt.datetime.fromisoformat(a.as_of),
            enforce=not a.no_enforce,
            events_dir=a.events,
            keep_snapshots=a.keep_snapshots,
        )
        print(json.dumps({"batch_id": rep.batch_id, "rows": rep.rows, "checks": rep.checks}, default=str))
    elif a.cmd == "stream-events":
        from scoreline.streaming import events as se

        once = not a.continuous
        ck, bronze, silver, log = (tables.path(x) for x in ("_checkpoints", "bronze_match_events", "stream_silver_events", "gold_top_scorers_log"))
        seen = tables.path("stream_progress")
        se.land_events(spark, a.input, bronze, f"{ck}/land", once, a.max_files_per_trigger, progress_path=seen, every=a.every)
        then = lambda: se.top_scorers(spark, silver, log)
        se.silver_events(spark, bronze, silver, f"{ck}/silver", once, then=then, every=a.every)
        if not once:
            spark.streams.awaitAnyTermination()
    else:
        from scoreline.streaming import standings as ss

        ss.run_standings(
            spark,
            a.input,
            tables,
            tables.path("_checkpoints/standings"),
            MATCHES_STREAM,
            available_now=not a.continuous,
            max_files=a.max_files_per_trigger,
            only_live=a.only_live,
            every=a.every,
        )
        if a.continuous:
            spark.streams.awaitAnyTermination()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
