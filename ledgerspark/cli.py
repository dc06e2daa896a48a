"""Command line: run a report over a landing folder, or keep it refreshed.

    python -m ledgerspark.cli report --landing ./download --out ./output [--variant current] [--format parquet]
    python -m ledgerspark.cli watch  --landing ./download --out ./output [--once]

``report`` reads the movement register and the registry (workbooks by default,
``--ledger-format csv|parquet`` otherwise) and the status exports present in
the folder, prints the row-level status counts (Q5) and the missing status
files, and writes the chosen report with the spreadsheet headers. ``watch``
re-runs it whenever a new workbook lands (``--once`` processes what is there
and stops).
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.plans.reports import REGISTER_LOOSE

VARIANTS = ("current", "presence", "cnm_registry", "soa_registry")
SINK_VARIANT = {"current": "current", "presence": "current", "cnm_registry": "cnm_registry",
                "soa_registry": "soa_registry"}
ACTIVE_STATUS = "Ativas"
KEY_MODES = {"strict": "strict", "loose": "loose", "mixed": REGISTER_LOOSE}


def ledgers(spark: SparkSession, landing: str, ledger_format: str, versioned: bool = False):
    """The three ledgers of a landing folder.

    Flat layout: ``Relatorio_CNM.xlsx``, ``Relatorio_SGP.xlsx`` and the status CSVs side by
    side. Versioned layout (``versioned=True``): ``ledger=CNM|SGP|SOA/load_ts=<ts>/…``, where
    the newest load of each ledger is used (STR2).
    """
    from ledgerspark.sources import exports

    base = landing.rstrip("/")
    if versioned:
        from ledgerspark.streaming.refresh import newest_version_folders

        folders = newest_version_folders(spark, base)
        mv_path, rg_path, se_path = folders["CNM"], folders["SGP"], folders["SOA"]
    else:
        ext = {"workbook": ".xlsx", "csv": ".csv", "parquet": ".parquet"}[ledger_format]
        mv_path = f"{base}/{exports.MOVEMENTS_FILE.rsplit('.', 1)[0]}{ext}"
        rg_path = f"{base}/{exports.REGISTRY_FILE.rsplit('.', 1)[0]}{ext}"
        se_path = base
    mv = exports.scan_movements(spark, mv_path, fmt=ledger_format)
    rg = exports.scan_registry(spark, rg_path, fmt=ledger_format)
    se, missing = exports.scan_status_exports(spark, se_path)
    return mv, rg, se, missing


def build_report(mv: DataFrame, rg: DataFrame, se: DataFrame, variant: str, key_mode: str) -> DataFrame:
    from ledgerspark.plans import reports

    active = se.where(F.col("fonte") == ACTIVE_STATUS)
    if variant == "current":
        return reports.unified_report(mv, rg, se, key_mode=key_mode)
    if variant == "presence":
        return reports.unified_presence_report(mv, rg, active, key_mode=key_mode)
    if variant == "cnm_registry":
        return reports.cnm_registry_report(mv, rg, key_mode=key_mode)
    return reports.soa_registry_report(active, rg, key_mode=key_mode)


def write(report: DataFrame, out: str, variant: str, fmt: str, html: bool) -> None:
    import time

    from ledgerspark.sources import sinks
    from ledgerspark.sources.workbook import write_workbooks

    target = f"{out.rstrip('/')}/resultado_{variant}"
    if fmt == "xlsx":  # a folder per run: parts of two results never mix
        write_workbooks(sinks.display_names(report, SINK_VARIANT[variant]), f"{target}/run={time.time_ns()}").collect()
    else:
        sinks.write_result(report, target, fmt=fmt, variant=SINK_VARIANT[variant])
    if html:
        sinks.write_html_rows(report, f"{out.rstrip('/')}/linhas_{variant}")


def gate(spark: SparkSession, args) -> None:
    """The legacy variants start only when the intake check passes every workbook they read."""
    from ledgerspark.sources import exports
    from ledgerspark.sources.landing import intake_check

    names = {"presence": (exports.MOVEMENTS_FILE, exports.REGISTRY_FILE), "cnm_registry": (exports.MOVEMENTS_FILE, exports.REGISTRY_FILE),
             "soa_registry": (exports.REGISTRY_FILE,)}.get(args.variant, ())
    if args.ledger_format != "workbook" or args.versioned:
        return
    for name in names:
        bad = intake_check(spark, f"{args.landing.rstrip('/')}/{name}").where("not ok").select("path", "reason").first()
        if bad is not None:
            raise SystemExit(f"intake check failed: {bad.path}: {bad.reason}")


def run_report(spark: SparkSession, args) -> None:
    from ledgerspark.plans import reports

    gate(spark, args)
    mv, rg, se, missing = ledgers(spark, args.landing, args.ledger_format, args.versioned)
    for name in missing:
        print(f"[warning] status file not found: {name}", file=sys.stderr)
    for row in reports.intake_report(mv, rg, se, KEY_MODES[args.key_mode]).orderBy("ledger").collect():
        print(f"[intake] {row.ledger}\t{row['rows']} rows\t{row.blank_documents} blank documents\t"
              f"{row.unreadable_dates} unreadable dates", file=sys.stderr)
    for row in reports.movement_status_counts(mv, rg, key_mode=KEY_MODES[args.key_mode]).collect():
        print(f"{row.status}\t{row['count']}")
    write(build_report(mv, rg, se, args.variant, KEY_MODES[args.key_mode]), args.out, args.variant, args.format, args.html)


def run_watch(spark: SparkSession, args) -> None:
    """Refresh whenever files land. A versioned landing is a file stream; a flat one, whose workbooks are
    overwritten in place, is a stream of listings. A refresh that failed is repeated."""
    import time

    from pyspark.errors import StreamingQueryException

    from ledgerspark.session import checkpoint_dir
    from ledgerspark.streaming import refresh
    from ledgerspark.streaming.landing_events import landing_events

    out = args.out.rstrip("/")
    result, log = f"{out}/resultado_{args.variant}", f"{out}/refresh_log"
    root = args.checkpoint or f"{checkpoint_dir(spark).rstrip('/')}/watch-{args.variant}"

    def build(s: SparkSession) -> DataFrame:
        mv, rg, se, _ = ledgers(s, args.landing, args.ledger_format, args.versioned)
        return build_report(mv, rg, se, args.variant, KEY_MODES[args.key_mode])

    once = {"availableNow": True} if args.once else {"processingTime": f"{args.every} seconds"}
    if args.versioned:
        files = refresh.watch_landing(spark, args.landing, glob=args.glob, recursive=True)
        refresh.refresh_report(files, build, result, log, root, once).awaitTermination()
        return
    files = landing_events(spark, args.landing, f"{root}/listings", glob=args.glob)
    while True:
        try:
            refresh.refresh_report(files, build, result, log, f"{root}/events", once, retry=True).awaitTermination()
        except StreamingQueryException as failed:
            print(f"[warning] {failed}", file=sys.stderr)
        if args.once:
            return
        time.sleep(args.every)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="ledgerspark")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("report", "watch"):
        c = sub.add_parser(name)
        c.add_argument("--landing", required=True)
        c.add_argument("--out", required=True)
        c.add_argument("--variant", choices=VARIANTS, default="current")
        c.add_argument("--ledger-format", choices=("workbook", "csv", "parquet"), default="workbook")
        c.add_argument("--key-mode", choices=tuple(KEY_MODES), default="strict",
                       help="mixed: loose keys for the two registers, strict ones for the exports")
        c.add_argument("--versioned", action="store_true",
                       help="landing holds ledger=<CNM|SGP|SOA>/load_ts=<ts>/ folders; use the newest of each")
    rep = sub.choices["report"]
    rep.add_argument("--format", choices=("parquet", "csv", "xlsx"), default="parquet")
    rep.add_argument("--html", action="store_true")
    w = sub.choices["watch"]
    w.add_argument("--glob", default="*.xlsx")
    w.add_argument("--once", action="store_true")
    w.add_argument("--every", type=int, default=60)
    w.add_argument("--checkpoint", default=None)
    args = p.parse_args(argv)

    from ledgerspark.session import get_spark

    spark = get_spark(cluster=True)
    if args.command == "report":
        run_report(spark, args)
    else:
        run_watch(spark, args)


if __name__ == "__main__":
    main()
