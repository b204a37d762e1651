"""Command line of the layered jobs.

    spark-submit -m tierwork run --warehouse s3a://bucket/wh --csv s3a://bucket/in
    python -m tierwork validate silver --warehouse /data/wh
"""

from __future__ import annotations

import argparse
import json
import logging
from datetime import timedelta

from .plans import pipeline
from .schema import CALENDAR_RANGE
from .session import build_session
from .sinks.tables import Warehouse
from .sources.jdbc import JdbcSource, column_slices

STEPS = ("silver", "gold", "platinum")


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tierwork")
    commands = parser.add_subparsers(dest="command", required=True)
    for name, about in [("run", "all layers with their gates"), ("ingest", "source tables to bronze"),
                        ("build", "one layer from the layer below"), ("validate", "quality gate of one layer")]:
        command = commands.add_parser(name, help=about)
        command.add_argument("--warehouse", required=True, help="root folder of the layers")
        command.add_argument("--namespace", default="", help="prefix of the database names")
        command.add_argument("--master", help="Spark master; on a cluster spark-submit supplies it")
        if name in ("run", "ingest"):
            source = command.add_mutually_exclusive_group(required=True)
            source.add_argument("--csv", help="folder of CSV files named <table>.csv")
            source.add_argument("--jdbc", help="JSON with url, driver, schema, properties")
            command.add_argument("--files", type=json.loads, default={}, help="JSON: table -> CSV file name")
            command.add_argument("--multiline", action="store_true", help="quoted CSV values hold line breaks")
            command.add_argument("--slices", type=json.loads, default={}, help="JSON: table -> [column, connections], for --jdbc")
            command.add_argument("--lookback", type=float, default=0, help="days before the watermark in which late rows are looked for")
        if name in ("run", "build"):
            command.add_argument("--calendar", nargs=2, metavar=("FIRST", "LAST"), default=CALENDAR_RANGE, help="days of the date dimension")
        if name == "build":
            command.add_argument("layer", choices=STEPS)
            command.add_argument("--audit", action="store_true", help="publish only when the layer's suite passes (silver, gold)")
        if name == "validate":
            command.add_argument("layer", choices=["bronze", "silver", "gold"])
    return parser


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    logging.getLogger("py4j").setLevel(logging.WARNING)
    spark = build_session(f"tierwork-{args.command}", args.master)
    wh = Warehouse(spark, args.warehouse, namespace=args.namespace)
    wh.bootstrap()
    pipeline.attach(wh)
    if args.command in ("run", "ingest"):
        if args.csv:
            read = pipeline.csv_reader(spark, args.csv, args.files, multiLine=args.multiline)
        else:
            source = JdbcSource(**json.loads(args.jdbc))
            cuts = {table: column_slices(spark, source, table, *cut) for table, cut in args.slices.items()}
            read = pipeline.jdbc_reader(spark, source, cuts)
        lookback = timedelta(days=args.lookback) if args.lookback else None
        if args.command == "run":
            pipeline.run_all(wh, read, calendar=tuple(args.calendar), lookback=lookback)
        else:
            pipeline.ingest_bronze(wh, read, lookback=lookback)
    elif args.command == "build":
        calendar = tuple(args.calendar)
        if args.layer == "gold":
            pipeline.build_gold(wh, calendar, args.audit)
        elif args.layer == "silver":
            pipeline.build_silver(wh, calendar if args.audit else None)
        else:
            pipeline.build_platinum(wh)
    else:
        pipeline.validate(wh, args.layer)


if __name__ == "__main__":
    main()
