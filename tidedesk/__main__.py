"""Command line, for spark-submit: ingest, live, tail, load, replay, consolidate, follow, vacuum and view."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession

from tidedesk.operators.validate import valid_rows, validate
from tidedesk.plans.replay import replay_store
from tidedesk.plans.rollup import refresh_rollup
from tidedesk.plans.views import VIEWS
from tidedesk.schema import REQUIRED_FIELDS, TOPIC, WINDOW_SECONDS
from tidedesk.session import build_session, pin_utc
from tidedesk.sources import tables
from tidedesk.sources.messages import read_kafka, read_message_files, spread
from tidedesk.sources.skipping import index_loads
from tidedesk.streaming.ingest import start_ingest
from tidedesk.streaming.live import live_kpis, start_live, start_tail


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidedesk", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, help: str) -> argparse.ArgumentParser:
        return commands.add_parser(name, help=help)

    streams = {
        "ingest": "stream messages into the tables",
        "live": "write KPIs per event-time window and channel",
        "tail": "write a line for every arriving contact",
    }
    for name, help in streams.items():
        stream = command(name, help)
        source = stream.add_mutually_exclusive_group(required=True)
        source.add_argument("--servers", help="Kafka bootstrap servers")
        source.add_argument("--files", help="folder of Parquet message files")
        stream.add_argument("--topic", default=TOPIC)
        stream.add_argument("--checkpoint", required=True)
        stream.add_argument("--drain", action="store_true", help="take what is there and end")
        stream.add_argument("--spread", type=int, help="deal messages out to so many tasks before they are parsed")
        if name == "tail":
            stream.add_argument("--out", required=True, help="folder of the text files")
        else:
            stream.add_argument("--root", required=True, help="folder of the tables")
            stream.add_argument("--ventana", type=int, default=WINDOW_SECONDS, help="seconds per load or window")
        if name == "ingest":
            stream.add_argument("--unique", help='leave out contacts that come again within, such as "1 hour"')

    load = command("load", "load JSON lines into the contacts table")
    load.add_argument("--json", required=True)
    load.add_argument("--root", required=True)
    load.add_argument("--append", action="store_true", help="add to the table instead of replacing it")

    replay = command("replay", "validate rejected messages again and append the repaired ones")
    replay.add_argument("--root", required=True)
    replay.add_argument("--optional", nargs="*", default=[], help="fields no longer required")

    consolidate = command("consolidate", "rewrite finished days as one clustered load each, and their load log")
    consolidate.add_argument("--root", required=True)
    consolidate.add_argument("--start", type=date.fromisoformat, required=True)
    consolidate.add_argument("--end", type=date.fromisoformat, required=True)

    follow = command("follow", "bring the stored aggregate and the file index up to date with the loads")
    follow.add_argument("--root", required=True)
    follow.add_argument("--sketched", action="store_true", help="with mergeable sketches of distinct orders")

    clean = command("vacuum", "remove folders that no commit has live")
    clean.add_argument("--root", required=True)
    clean.add_argument("--hours", type=float, default=24, help="and that nothing has changed for so long")

    view = command("view", "print a KPI view")
    view.add_argument("--root", required=True)
    view.add_argument("--name", choices=VIEWS, required=True)
    view.add_argument("--rows", type=int, help="print so many rows at most and say that there are more")
    view.add_argument("--out", help="write the whole view there as CSV instead")
    return parser


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    found = read_kafka(spark, args.servers, args.topic) if args.servers else read_message_files(spark, args.files)
    return spread(found, args.spread) if args.spread else found


def _print(rows: DataFrame, limit: int | None) -> None:
    """All rows as tab-separated lines, one partition at a time in the driver; or the first ``limit``."""
    print("\t".join(rows.columns))
    for n, row in enumerate((rows if limit is None else rows.limit(limit + 1)).toLocalIterator()):
        if n == limit:
            print(f"... more than {limit} rows")
            break
        print("\t".join("" if value is None else str(value) for value in row))


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = pin_utc(spark or build_session())
    if args.command == "tail":
        start_tail(_messages(spark, args), args.out, args.checkpoint, drain=args.drain).awaitTermination()
        return
    store = tables.ContactStore(args.root)
    if args.command == "live":
        windows = live_kpis(valid_rows(validate(_messages(spark, args))), args.ventana)
        start_live(windows, store.live, args.checkpoint, drain=args.drain, seconds=args.ventana).awaitTermination()
    elif args.command == "ingest":
        start_ingest(
            _messages(spark, args), store, args.checkpoint, args.ventana, drain=args.drain, unique_within=args.unique
        ).awaitTermination()
    elif args.command == "load":
        rows = tables.read_contact_json(spark, args.json)
        tables.write_contacts(rows, store.contacts, mode="append" if args.append else "overwrite")
    elif args.command == "consolidate":
        tables.consolidate_days(spark, store, args.start, args.end)
        tables.merge_load_log(spark, store, args.end + timedelta(days=1))
    elif args.command == "follow":
        refresh_rollup(spark, store, args.sketched)
        index_loads(spark, store)
    elif args.command == "vacuum":
        for path in tables.vacuum(spark, store, timedelta(hours=args.hours)):
            print(path)
    elif args.command == "replay":
        replay_store(spark, store, [name for name in REQUIRED_FIELDS if name not in args.optional])
    else:
        rows = VIEWS[args.name](tables.read_contacts(spark, store.contacts))
        if args.out:
            rows.write.mode("error").option("header", "true").csv(args.out)
        else:
            _print(rows, args.rows)


if __name__ == "__main__":
    main()
