"""Command line of the lake: ``python -m clicklake <command> ...``. A failed run exits with 1."""

from __future__ import annotations

import argparse
import logging
import sys
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clicklake.operators.slices import as_day, next_day
from clicklake.plans.bronze import dates_touched_by, land
from clicklake.plans.gate import validate_layer, warn_about_nulls
from clicklake.plans.gold import build_funnel, build_gold, build_sessions, build_sketches
from clicklake.plans.health import lake_health, run_measures, stored_layers
from clicklake.plans.keys import rebuild_keys
from clicklake.plans.runs import STAGES, backfill_gaps, run_day, run_range
from clicklake.plans.silver import rebuild_all_silver, rebuild_silver
from clicklake.schemas import BRONZE_ROW_RANGE, TABLES
from clicklake.session import build_session
from clicklake.sources.jdbc import extract_jdbc
from clicklake.sources.lake import Lake, preview, read_bronze, read_silver, read_with_evolution
from clicklake.sources.samples import SAMPLE_CLICKS, SAMPLE_SESSIONS, generate
from clicklake.sources.snapshots import compact, expire
from clicklake.streaming.jobs import hybrid_run, late_rows, repair_late, replay, stream_to_silver
from clicklake.streaming.positions import batch_at
from clicklake.streaming.sources import stream_files

log = logging.getLogger("clicklake")


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="clicklake", description=__doc__)
    root.add_argument("--lake", required=True, help="root path of the lake")
    commands = root.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *, dates: bool = False, source: bool = False) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        if dates:
            sub.add_argument("start", help="first day, YYYY-MM-DD")
            sub.add_argument("end", help="day after the last one")
        if source:
            sub.add_argument("--source", help="path of the source table, or a jdbc: URL")
            sub.add_argument("--table", choices=sorted(TABLES), default="clicks")
            sub.add_argument("--property", action="append", default=[], metavar="KEY=VALUE", help="JDBC property")
            sub.add_argument("--partitions", type=int, default=32, help="parallel JDBC reads")
        return sub

    def rows_option(sub: argparse.ArgumentParser) -> None:
        text = "fewest and most rows the raw suite accepts"
        sub.add_argument("--row-range", nargs=2, type=int, default=BRONZE_ROW_RANGE, metavar=("LOW", "HIGH"), help=text)

    command("bronze", "land the rows changed in a range", dates=True, source=True)
    silver = command("silver", "rebuild the dates touched by a landed range", dates=True)
    commands.choices["bronze"].add_argument("--preview", action="store_true", help="show a few landed rows")
    silver.add_argument("--preview", action="store_true", help="show a few refined rows")
    silver.add_argument("--full", action="store_true", help="rebuild everything instead")
    silver.add_argument("--table", choices=sorted(TABLES), default="clicks")
    gold = command("gold", "rebuild the metrics of one date, or of all")
    gold.add_argument("--date")
    command("sessions", "rebuild the session table and the conversion funnel")
    day = command("run-day", "raw, refined and aggregated layers of one day", source=True)
    day.add_argument("day")
    backfill = command("backfill", "the same for a range", dates=True, source=True)
    for sub in (day, backfill):
        for stage in STAGES:
            sub.add_argument(f"--skip-{stage}", dest="skip", action="append_const", const=stage)
        sub.add_argument("--dry-run", action="store_true")
        sub.add_argument("--gate", choices=["bronze", "strict"], help="suite the raw rows must pass")
        rows_option(sub)
    command("sketches", "rebuild the hourly sketches of users and sessions").add_argument("--date")
    stream = command("stream", "keep raw and refined clicks current from a folder of files")
    hybrid = command("hybrid", "history by one batch up to a moment, then the stream from it")
    hybrid.add_argument("--history", required=True, help="path of the source table")
    hybrid.add_argument("--cutover", required=True, help="moment of change from which the stream is taken")
    for sub in (stream, hybrid):
        sub.add_argument("--source", required=True, help="folder that files arrive in")
        sub.add_argument("--checkpoint", required=True)
        sub.add_argument("--files", type=int, help="files of a micro-batch")
        sub.add_argument("--drain", action="store_true", help="stop when all there is now is landed")
    stream.add_argument("--delay", help="set rows behind a watermark of this delay aside, for repair-late")
    command("repair-late", "land the rows that streams set aside")
    again = command("replay", "land the batches of a stream again, from a recorded position")
    again.add_argument("--checkpoint", required=True)
    position = again.add_mutually_exclusive_group(required=True)
    position.add_argument("--from-batch", type=int)
    position.add_argument("--since", help="first batch that ran at this moment (UTC) or later")
    tidy = command("compact", "merge small commits of the raw layer, and delete files that no kept version names")
    tidy.add_argument("--table", choices=sorted(TABLES), default="clicks")
    tidy.add_argument("--rebuild-keys", action="store_true", help="make the index of keys anew")
    command("verify-backfill", "list the dates a layer has no rows for", dates=True)
    health = command("health", "state of every layer and of the runs; fails when a target is missed", dates=True)
    health.add_argument("--now", help="moment to judge by; the present if not given")
    validate = command("validate", "totals and null keys of the raw layer; warns only")
    validate.add_argument("--date")
    quality = command("quality", "run a suite over a stored table")
    quality.add_argument("--input", required=True)
    quality.add_argument("--layer", choices=["bronze", "silver", "strict"], default="bronze")
    rows_option(quality)
    sample = command("sample", "write sample clicks and sessions")
    sample.add_argument("--output", required=True)
    sample.add_argument("--clicks", type=int, default=SAMPLE_CLICKS)
    sample.add_argument("--sessions", type=int, default=SAMPLE_SESSIONS)
    sample.add_argument("--seed", type=int, default=42)
    return root


def source_rows(spark: SparkSession, args: argparse.Namespace, start: str, end: str) -> DataFrame:
    spec = TABLES[args.table]
    if not args.source:
        raise ValueError("--source is needed unless the raw stage is skipped")
    if args.source.startswith("jdbc:"):
        properties = dict(p.split("=", 1) for p in args.property)
        return extract_jdbc(spark, args.source, start, end, spec, args.partitions, **properties)
    return read_with_evolution(spark, args.source)


def execute(spark: SparkSession, args: argparse.Namespace) -> bool:
    lake = Lake(args.lake.rstrip("/"))
    if args.command == "bronze":
        rows = source_rows(spark, args, args.start, args.end)
        landed = land(spark, lake, rows, args.start, args.end, spec=TABLES[args.table])
        log.info("%d rows landed", landed.written.rows)
        if args.preview:
            preview(read_bronze(spark, lake, args.start, args.end, TABLES[args.table])).show(truncate=False)
    elif args.command == "silver":
        spec = TABLES[args.table]
        if args.full:
            written = rebuild_all_silver(spark, lake, spec)
        else:
            written = rebuild_silver(spark, lake, dates_touched_by(spark, lake, args.start, args.end, spec), spec)
        log.info("%d rows refined", written.rows)
        if args.preview:
            columns = (spec.key, *spec.derived, "event_date")
            preview(read_silver(spark, lake, spec=spec), *columns).show(truncate=False)
    elif args.command == "gold":
        report = build_gold(spark, lake, [as_day(args.date)] if args.date else None)
        for name, error in report.failures.items():
            log.error("%s: %s", name, error)
        return not report.failures
    elif args.command == "sessions":
        log.info("%d sessions, %d days of the funnel", build_sessions(spark, lake), build_funnel(spark, lake))
    elif args.command == "sketches":
        log.info("%d sketches", build_sketches(spark, lake, [as_day(args.date)] if args.date else None).rows)
    elif args.command in ("stream", "hybrid"):
        arriving = stream_files(spark, args.source, args.files)
        if args.command == "stream":
            query = stream_to_silver(arriving, lake, args.checkpoint, args.drain, delay=args.delay)
        else:
            history = read_with_evolution(spark, args.history)
            query = hybrid_run(spark, lake, history, arriving, args.cutover, args.checkpoint, args.drain)
        query.awaitTermination()
        log.info("%d rows came behind the watermark so far", late_rows(spark, lake))
    elif args.command == "repair-late":
        log.info("%d late rows landed", repair_late(spark, lake))
    elif args.command == "replay":
        start = args.from_batch if args.since is None else batch_at(spark, args.checkpoint, args.since)
        if start is None:
            log.error("no batch ran at %s or later", args.since)
            return False
        log.info("%d batches landed again from number %d", replay(spark, lake, args.checkpoint, start), start)
    elif args.command == "compact":
        spec = TABLES[args.table]
        log.info("%d commits merged", compact(spark, lake.bronze(spec), spec.bronze, [F.col(spec.key)], most=1))
        expire(spark, lake.bronze(spec))
        if args.rebuild_keys:
            rebuild_keys(spark, lake, spec)
    elif args.command in ("run-day", "backfill"):
        options = {
            "skip": args.skip or (), "dry_run": args.dry_run, "gate": args.gate, "spec": TABLES[args.table],
            "row_range": tuple(args.row_range),
        }
        if args.command == "run-day":
            bounds = (args.day, str(next_day(args.day)))
            report = run_day(spark, lake, lambda: source_rows(spark, args, *bounds), args.day, **options)
        else:
            bounds = (args.start, args.end)
            report = run_range(spark, lake, lambda: source_rows(spark, args, *bounds), *bounds, **options)
        for line in report.planned:
            log.info("%s%s", "would run " if args.dry_run else "", line)
        for name, error in report.failures.items():
            log.error("%s: %s", name, error)
        return report.success
    elif args.command == "verify-backfill":
        gaps = backfill_gaps(spark, lake, args.start, args.end)
        for layer, days in gaps.items():
            log.info("%s lacks %s", layer, ", ".join(map(str, days)) or "nothing")
        return not any(gaps.values())
    elif args.command == "health":
        now = args.now or datetime.now(timezone.utc).replace(tzinfo=None).isoformat()
        state = lake_health(stored_layers(spark, lake), now, args.start, args.end).collect()
        measures = run_measures(spark, lake, now).collect()
        for row in (*state, *measures):
            log.info("%s", row.asDict())
        return not any(row["breached"] for row in (*state, *measures))
    elif args.command == "validate":
        bounds = (args.date, next_day(args.date)) if args.date else ()
        log.info("%s", warn_about_nulls(spark, lake, *bounds))
    elif args.command == "quality":
        return validate_layer(spark, args.input, args.layer, tuple(args.row_range)).success
    elif args.command == "sample":
        clicks, sessions = generate(spark, args.clicks, args.sessions, args.seed)
        clicks.write.mode("overwrite").parquet(f"{args.output}/clicks")
        sessions.write.mode("overwrite").parquet(f"{args.output}/sessions")
    return True


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(levelname)s %(message)s")
    spark = build_session()
    return 0 if execute(spark, args) else 1


if __name__ == "__main__":
    sys.exit(main())
