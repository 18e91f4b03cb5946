"""``spark-submit`` entry point: one sub-command per job."""

from __future__ import annotations

import argparse
import time

from shelfwise.plans.imports import job_import, job_import_raw
from shelfwise.plans.recommend import BUCKETS, Sizing, job_incremental, job_offline, job_stream, job_train
from shelfwise.plans.warehouse import document_warehouse, file_warehouse
from shelfwise.session import build_session
from shelfwise.streaming.channels import kafka_options
from shelfwise.streaming.retrain import BATCH_INTERVAL


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="shelfwise")
    parser.add_argument("--tables", help="folder of the stored tables")
    parser.add_argument("--store-format", help="connector format instead of a folder")
    parser.add_argument("--store-option", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument(
        "--shuffle-partitions", type=int, default=4000, help="before adaptive execution merges small ones"
    )
    parser.add_argument("--als-blocks", type=int, default=Sizing.blocks, help="factor blocks of each side; part of the model; by the number of ratings unless given")
    parser.add_argument("--checkpoint-interval", type=int, default=Sizing.checkpoint_interval, help="ALS iterations between checkpoints")
    jobs = parser.add_subparsers(dest="job", required=True)
    jobs.add_parser("import").add_argument("csv")
    raw = jobs.add_parser("import-raw")
    raw.add_argument("csv")
    raw.add_argument("--incremental", action="store_true")
    raw.add_argument("--with-items", action="store_true")
    raw.add_argument("--import-id", help="name of the import; the same name replaces it")
    train = jobs.add_parser("train")
    train.add_argument("model_path")
    train.add_argument("--fit-on", choices=["train", "all"], default="train")
    offline = jobs.add_parser("offline")
    offline.add_argument("--suffix", default="")
    offline.add_argument("--fit-on", choices=["train", "all"], default="train")
    offline.add_argument("--as-of", type=int, default=int(time.time()))
    offline.add_argument("--buckets", type=int, default=BUCKETS, help="folders of the stored lists, by user")
    jobs.add_parser("incremental").add_argument("--as-of", type=int, default=int(time.time()))
    stream = jobs.add_parser("stream")
    stream.add_argument("brokers")
    stream.add_argument("topics")
    stream.add_argument("work_path")
    stream.add_argument("--retrain-every", type=int, default=1)
    stream.add_argument("--interval", default=BATCH_INTERVAL)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(
        f"shelfwise {args.job}", conf={"spark.sql.shuffle.partitions": str(args.shuffle_partitions)}
    )
    if args.store_format:
        tables = document_warehouse(_options(args.store_option), args.store_format)
    else:
        tables = file_warehouse(args.tables)
    sizing = Sizing(args.als_blocks, args.checkpoint_interval)
    if args.job == "import":
        print(job_import(spark, args.csv, tables))
    elif args.job == "import-raw":
        print(job_import_raw(spark, args.csv, tables, args.incremental, args.with_items, args.import_id))
    elif args.job == "train":
        job_train(spark, tables, args.model_path, fit_on=args.fit_on, sizing=sizing).show(truncate=False)
    elif args.job == "offline":
        report = job_offline(spark, tables, args.as_of, args.suffix, fit_on=args.fit_on, sizing=sizing, buckets=args.buckets)
        report.show(truncate=False)
    elif args.job == "incremental":
        job_incremental(spark, tables, args.as_of, sizing=sizing)
    else:
        source = ("kafka", kafka_options(args.brokers, args.topics))
        sink = ("kafka", {"kafka.bootstrap.servers": args.brokers})
        stream = job_stream(
            spark, tables, source, sink, args.work_path, retrain_every=args.retrain_every, interval=args.interval, sizing=sizing
        )
        stream.awaitTermination()


if __name__ == "__main__":
    main()
