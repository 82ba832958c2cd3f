"""Command line: ``python -m tillflow <command> ...``.

batch   load every receipt file under --source into the targets
stream  keep loading files as they arrive (or --once: process what is there)
events  load the files that arrival events name, then stop
rejects reasons and counts of what the loads have turned away
write-processed  the four tables of the receipts under --source as processed CSV outputs
load    load processed CSV outputs into the targets, by their names
compact rewrite target folders that hold many small files
check   constraint report (keys, references, nulls, lengths) of the targets
profile quantity profile of the loaded link table
"""

from __future__ import annotations

import argparse

from tillflow.functions.hashing import SHA256, SHAKE256, IdScheme
from tillflow.functions.timeparse import DAY_FIRST_FORMATS, ISO_FORMATS, MONTH_FIRST_FORMATS
from tillflow.schemas import KEYS


def _ids(args) -> IdScheme:
    base = SHAKE256 if args.id_hash == "shake256" else SHA256
    return IdScheme(base.kind, card_style=args.card_text)


def _formats(args):
    extra = {"iso": (), "day-first": DAY_FIRST_FORMATS, "month-first": MONTH_FIRST_FORMATS}[args.dates]
    return ISO_FORMATS + extra


def _say(added: dict[str, int]) -> None:
    for table, n in added.items():
        print(f"{table}: {n} rows added")


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="tillflow")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("batch", "stream", "events", "write-processed"):
        s = sub.add_parser(name)
        if name != "events":
            s.add_argument("--source", required=True, help="folder (or glob) of headerless receipt CSV files")
        if name != "write-processed":
            s.add_argument("--targets", required=True, help="folder holding the target tables")
        s.add_argument("--id-hash", choices=["sha256", "shake256"], default="sha256")
        s.add_argument("--card-text", choices=["string", "float"], default="string")
        s.add_argument("--dates", choices=["iso", "day-first", "month-first"], default="iso")
        s.add_argument("--multiline", action="store_true", help="line breaks inside quoted fields")
        if name == "batch":
            s.add_argument("--landing", help="folder that keeps every raw line, one partition a file")
        if name == "write-processed":
            s.add_argument("--out", required=True, help="folder for the outputs")
            s.add_argument("--name", required=True, help="name of the source, as in receipts/2021-08-25.csv")
        if name == "events":
            s.add_argument("--events", required=True, help="folder (or glob) of event files, one JSON event to a line")
            s.add_argument("--root", required=True, help="folder or store URL in which the buckets lie")
            s.add_argument("--archive", help="folder that takes up event files once they are done")
        if name in ("stream", "events"):
            s.add_argument("--checkpoint", required=True)
        if name == "stream":
            s.add_argument("--once", action="store_true")
            s.add_argument("--every", default="1 minute")
            s.add_argument("--max-files", type=int, default=None, help="files of a micro-batch at most (default: all)")
    for name in ("check", "profile", "rejects", "compact", "load"):
        s = sub.add_parser(name)
        s.add_argument("--targets", required=True)
        if name == "check":
            s.add_argument("--id-hash", choices=["sha256", "shake256"], default="sha256")
            s.add_argument("--card-text", choices=["string"], default="string")
        if name == "load":
            s.add_argument("--processed", required=True, help="folder of processed CSV outputs")
    args = p.parse_args(argv)

    from tillflow.session import get_session

    spark = get_session(args.master)
    if args.cmd == "batch":
        from tillflow.operators.load import load_receipts
        from tillflow.sinks.tables import land_raw
        from tillflow.sources.csv import read_receipts

        if args.landing:
            land_raw(spark, args.source, args.landing)
        _say(load_receipts(read_receipts(spark, args.source, _formats(args), multi_line=args.multiline), args.targets, spark, _ids(args)))
    elif args.cmd == "stream":
        from tillflow.streaming import ingest

        options = {"ids": _ids(args), "formats": _formats(args), "max_files_per_trigger": args.max_files, "multi_line": args.multiline}
        if args.once:
            _say(ingest.run_available(spark, args.source, args.targets, args.checkpoint, **options))
        else:
            ingest.start(spark, args.source, args.targets, args.checkpoint, args.every, **options).awaitTermination()
    elif args.cmd == "events":
        from tillflow.streaming import events

        done = events.run_available(spark, args.events, args.root, args.targets, args.checkpoint, args.archive, _ids(args), _formats(args), args.multiline)
        _say(done.added)
        print(f"files {done.files}, missing {done.missing}, unreadable events {done.unreadable}")
    elif args.cmd == "write-processed":
        from tillflow.operators.normalize import normalize
        from tillflow.sinks.csv import write_processed
        from tillflow.sources.csv import read_receipts

        n = normalize(read_receipts(spark, args.source, _formats(args), multi_line=args.multiline), _ids(args), by_file=True)
        paths = write_processed({t: n.table(t) for t in KEYS}, args.out, args.name)
        print("\n".join(paths.values()))
    elif args.cmd == "load":
        from tillflow.operators.processed import load_processed

        added, unknown = load_processed(spark, args.processed, args.targets)
        _say(added)
        for name in unknown:
            print(f"no table for {name}")
    elif args.cmd == "rejects":
        from tillflow.operators.load import reject_report

        reject_report(spark, args.targets).orderBy("kind", "reason").show(100, truncate=False)
    elif args.cmd == "compact":
        from tillflow.schemas import REJECTS
        from tillflow.sinks.tables import compact

        for t in (*KEYS, *REJECTS):
            print(f"{t}: {compact(spark, args.targets, t)} folders rewritten")
    elif args.cmd == "check":
        from tillflow.operators import quality
        from tillflow.operators.load import targets

        t = targets(spark, args.targets)
        for report in (quality.dq_unique(t), quality.dq_foreign(t), quality.dq_not_null(t), quality.dq_length(t, _ids(args))):
            report.show(100, truncate=False)
    elif args.cmd == "profile":
        from tillflow.operators.load import targets
        from tillflow.operators.profile import qty_profile

        qty_profile(targets(spark, args.targets)["orders_products"]).show()


if __name__ == "__main__":
    main()
