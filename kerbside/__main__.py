"""Command line: `python -m kerbside <command>`, or through spark-submit on a cluster."""

from __future__ import annotations

import argparse
from contextlib import nullcontext

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from kerbside.operators.quality import validate_inputs, validate_outputs
from kerbside.plans import warehouse as wh
from kerbside.plans.questions import QUESTIONS
from kerbside.schemas import FEEDS
from kerbside.session import build_session, sized_for
from kerbside.sources import topics
from kerbside.sources.files import read_csv, scan
from kerbside.streaming import runs

TABLES = {feed.keyed_table: name for name, feed in FEEDS.items()}


def layers(args: argparse.Namespace) -> None:
    """Feed files to typed, cleaned and report tables, with checks before and after."""
    spark = build_session()
    if args.layer in ("bronze", "all"):
        validate_inputs(spark, args.input_dir)
    wh.run_layers(spark, args.input_dir, args.warehouse_dir, args.layer, args.on_error).show(truncate=False)
    if args.layer in ("gold", "all"):
        validate_outputs(spark, args.warehouse_dir)


def send(args: argparse.Namespace) -> None:
    """Feed files to topics: broker topics with --servers, else folders of records."""
    spark = build_session()
    with sized_for(spark, args.input_dir):
        _send(spark, args)


def _send(spark: SparkSession, args: argparse.Namespace) -> None:
    for name in args.topics or FEEDS:
        feed = FEEDS[name]
        rows = read_csv(spark, f"{args.input_dir}/{name}.csv")
        if args.limit:
            # The first lines of the feed, not any.
            rows = rows.withColumn("_place", F.monotonically_increasing_id()).orderBy("_place").limit(args.limit)
        records = topics.topic_records(rows, feed, [c for c in rows.columns if c != "_place"])
        if args.servers:
            topics.write_topic(records, args.servers)
        else:
            topics.write_topic_files(records, f"{args.topic_dir}/{name}")


def stream(args: argparse.Namespace) -> None:
    """Topics to window tables, until stopped, for some seconds, or once."""
    spark = build_session()

    def source(topic: str):
        if args.servers:
            most = {"maxOffsetsPerTrigger": str(args.max_per_batch)} if args.max_per_batch else {}
            return topics.read_topic(spark, topic, args.servers, **most)
        most = {"maxFilesPerTrigger": str(args.max_per_batch)} if args.max_per_batch else {}
        return topics.read_topic_files(spark, f"{args.topic_dir}/{topic}", **most)

    with runs.state_partitions(spark, args.state_partitions or spark.sparkContext.defaultParallelism):
        runs.run_topics(spark, source, args.warehouse_dir, args.topics, args.runtime, delay=args.delay, once=args.once,
                        drop_repeats=args.drop_repeats, move=args.move)


def tail(args: argparse.Namespace) -> None:
    """The first records of each topic, and how many there are."""
    spark = build_session()
    if args.servers:
        found = [topics.read_topic_batch(spark, t, args.servers) for t in args.topics or FEEDS]
        order = [F.col("partition"), F.col("offset")]
    else:
        found = [topics.read_topic_files_batch(spark, f"{args.topic_dir}/{t}")
                 .withColumn("topic", F.lit(t)) for t in args.topics or FEEDS]
        order = [F.col(c) for c in topics.ARRIVAL]
    text = [df.select("topic", F.col("key").cast("string"), F.col("value").cast("string"),
                      *[c for c in ("partition", "offset", "written_at") if c in df.columns]) for df in found]
    with nullcontext() if args.servers else sized_for(spark, args.topic_dir):
        topics.tail(text, args.limit, order).show(args.limit * len(text), truncate=False)
        topics.topic_counts(topics.union_all(text)).show(truncate=False)


def keyed(args: argparse.Namespace) -> None:
    """Load the keyed tables from the cleaned ones, then update, delete, compare and list versions."""
    spark = build_session()
    with sized_for(spark, f"{args.warehouse_dir}/silver"):
        _keyed(spark, args)


def _keyed(spark: SparkSession, args: argparse.Namespace) -> None:
    chosen = [TABLES[args.table]] if args.table else list(FEEDS)
    tables = wh.load_keyed_tables(
        spark, {name: scan(spark, f"{args.warehouse_dir}/silver/{name}") for name in chosen}, args.warehouse_dir)
    if args.skip_demo:
        return
    if "ride_events" in tables:
        wh.close_open_rides(tables["ride_events"])
        wh.open_rides_since(tables["ride_events"], 0).show()
        tables["ride_events"].history(10).show(truncate=False)
    if "driver_location_events" in tables:
        wh.erase_driver(tables["driver_location_events"]).show()


def sql(args: argparse.Namespace) -> None:
    """SQL, or a standing question by name, over the stored tables."""
    spark = build_session()
    print("views:", ", ".join(wh.register_warehouse(spark, args.warehouse_dir)))
    with sized_for(spark, args.warehouse_dir):
        wh.run_query(spark, QUESTIONS.get(args.query, args.query), args.max_rows).show(args.max_rows, truncate=False)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="kerbside")
    commands = top.add_subparsers(required=True)

    def command(name, run, *options):
        sub = commands.add_parser(name, help=(run.__doc__ or "").split("\n")[0])
        sub.set_defaults(run=run)
        for flags, settings in options:
            sub.add_argument(flags, **settings)

    warehouse = ("--warehouse-dir", {"default": "warehouse"})
    inputs = ("--input-dir", {"default": "input"})
    topic_dir = ("--topic-dir", {"default": "topics"})
    servers = ("--servers", {"default": None, "help": "broker addresses; without them topics are folders"})
    chosen = ("--topics", {"nargs": "+", "choices": list(FEEDS), "default": None})
    command("layers", layers, inputs, warehouse, ("--layer", {"choices": [*wh.LAYERS, "all"], "default": "all"}),
            ("--on-error", {"choices": ["raise", "null"], "default": "raise", "help": "malformed cells"}))
    command("send", send, inputs, topic_dir, servers, chosen, ("--limit", {"type": int, "default": None}))
    command("stream", stream, topic_dir, servers, chosen, warehouse, ("--runtime", {"type": int, "default": None}),
            ("--once", {"action": "store_true", "help": "stop when all records present are read"}),
            ("--max-per-batch", {"type": int, "default": None, "help": "records (broker) or files (folder) a time"}),
            ("--drop-repeats", {"action": "store_true", "help": "drop records delivered again within the delay"}),
            ("--delay", {"default": runs.DELAY}), ("--state-partitions", {"type": int, "default": None}),
            ("--move", {"action": "store_true", "help": "go on under a new checkpoint, with other state partitions"}))
    command("tail", tail, topic_dir, servers, chosen, ("--limit", {"type": int, "default": 3}))
    command("keyed", keyed, warehouse, ("--table", {"choices": list(TABLES), "default": None}),
            ("--skip-demo", {"action": "store_true"}))
    command("sql", sql, warehouse, ("query", {"help": f"SQL, or one of: {', '.join(QUESTIONS)}"}),
            ("--max-rows", {"type": int, "default": 20}))
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(args)


if __name__ == "__main__":
    main()
