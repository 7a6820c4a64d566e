"""Jobs for ``spark-submit``: ingest landed documents, consume topics, show the status.

    ingest stations --documents DIR --stage-scales DIR --topics kafka:HOST:9092 --checkpoint DIR
    ingest measurements --documents DIR --topics file:DIR --checkpoint DIR --match status=Active
    consume --topics kafka:HOST:9092 --checkpoint DIR --history DIR
    consume --topics kafka:HOST:9092 --checkpoint DIR --rejects DIR --jdbc-url URL --jdbc-driver CLASS
    consume --topics kafka:HOST:9092 --checkpoint DIR --rejects DIR --keyspace NAME
    consume --topics kafka:HOST:9092 --checkpoint DIR --rejects DIR --database NAME
    state --topics kafka:HOST:9092 --checkpoint DIR [--state DIR] --partitions N
    compact --history DIR | --state DIR
    metrics --history DIR | --state DIR --output DIR
    snapshot --history DIR --output DIR [--snapshot DIR]
    status --history DIR --output DIR [--snapshot DIR]
    refresh --history DIR --view DIR
    status --state DIR --output DIR
    status --view DIR --output DIR
    status --checkpoint DIR --output DIR
    status --database NAME --output DIR
    status --jdbc-url URL --jdbc-driver CLASS [--jdbc-view NAME | --jdbc-key-hash SQL] --output DIR
    views --database NAME

A database's user and password are read from JDBC_USER and JDBC_PASSWORD; settings of a
Cassandra cluster are given to Spark as ``--conf spark.cassandra.*``. Options of a broker are given
as ``--topic-option kafka.security.protocol=SASL_SSL``.
"""

import argparse
import os

from gaugewright.operators.latest import latest_by_key
from gaugewright.plans.current import compact_current, current_rows, two_pass_by_date, write_snapshot
from gaugewright.plans.ingest import measurement_output, station_output
from gaugewright.plans.maintained import BUCKETS, COMPACT_EVERY as COMPACT_REFRESHES, JoinedView
from gaugewright.plans.scales import StageScales
from gaugewright.plans.status import map_rows
from gaugewright.plans.views import JOINED_COLUMNS, create_views, join_current, stations_measurements
from gaugewright.schemas import MEASUREMENTS, STATIONS, create_tables
from gaugewright.session import build_session
from gaugewright.sinks.history import HistorySink, TableSink
from gaugewright.sinks.relational import JdbcSink, JdbcTarget
from gaugewright.sinks.wide_column import KeyspaceTarget, WideColumnSink
from gaugewright.sources.documents import read_documents, read_items
from gaugewright.sources.epochs import read_metrics
from gaugewright.sources.history import read_jdbc, read_jdbc_history
from gaugewright.sources.topics import FileTopics, KafkaTopics
from gaugewright.streaming.consume import (
    TRIGGER,
    await_all,
    consume,
    fan_out,
    start_topics,
    to_topics,
)
from gaugewright.streaming.progress import BatchLog
from gaugewright.streaming.state import (
    COMPACT_EVERY,
    compact_state,
    read_checkpoint,
    read_state,
    start_latest_state,
)

# What a batch of ingest takes at most, unless told otherwise: the first one meets the whole landing folder.
MAX_BATCH = "100g"
UNITS = {"k": 10, "m": 20, "g": 30, "t": 40}


def _topics(text):
    kind, _, place = text.partition(":")
    if kind in ("kafka", "file") and place:
        return kind, place
    raise argparse.ArgumentTypeError("topics are kafka:SERVERS or file:FOLDER")


def _bytes(text):
    """Spark takes a plain number here."""
    number, unit = text[:-1], text[-1:].lower()
    if unit in UNITS and number.isdigit():
        return int(number) << UNITS[unit]
    if text.isdigit():
        return int(text)
    raise argparse.ArgumentTypeError("sizes are numbers, with k, m, g or t behind them or not")


def _pair(text):
    name, sign, value = text.partition("=")
    if not sign or not name:
        raise argparse.ArgumentTypeError("write NAME=VALUE")
    return name, value


def _database_arguments(parser):
    parser.add_argument("--database", help="catalog database of history tables")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-driver")
    parser.add_argument("--jdbc-schema")
    parser.add_argument("--connections", type=int, default=8, help="of a database at once")


def _arguments(argv):
    parser = argparse.ArgumentParser(prog="gaugewright")
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest")
    ingest.add_argument("topic", choices=[STATIONS, MEASUREMENTS])
    ingest.add_argument("--documents", required=True)
    ingest.add_argument("--stage-scales")
    layout = ingest.add_mutually_exclusive_group()
    layout.add_argument("--lines", action="store_true", help="one document per line")
    layout.add_argument("--items", action="store_true", help="one item per line")
    ingest.add_argument("--fetched-at", help="field of a document, or item, with its fetch time")
    ingest.add_argument("--scales-fetched-at", help="the same of stage-scale documents")
    ingest.add_argument("--match", action="append", default=[], type=_pair, metavar="ATTRIBUTE=VALUE",
                        help="only items with this raw attribute; may be given more than once")
    ingest.add_argument("--key", default="raw", help="message key: raw item, or a message field")
    ingest.add_argument("--strict", action="store_true", help="fail on a station without stage scale")
    ingest.add_argument("--keep-bad", action="store_true",
                        help="send bad documents and items to the rejects topic instead of failing")
    bound = ingest.add_mutually_exclusive_group()
    bound.add_argument("--max-files", type=int, help="of a batch")
    bound.add_argument("--max-bytes", type=_bytes, help=f"of a batch, such as 10g; {MAX_BATCH} if no bound is given")

    consumer = jobs.add_parser("consume")
    consumer.add_argument("--history")
    consumer.add_argument("--keyspace")
    consumer.add_argument("--rejects", help="folder for what other targets than --history cannot hold")
    _database_arguments(consumer)

    state = jobs.add_parser("state")
    state.add_argument("--state", help="folder of a change log; without it the checkpoint alone holds the state")
    state.add_argument("--partitions", type=int, help="fixed at the first start")
    state.add_argument("--compact-every", type=int, metavar="EPOCHS", help=f"of the change log; {COMPACT_EVERY}")

    for streaming in (ingest, consumer, state):
        streaming.add_argument("--topics", type=_topics, required=True)
        streaming.add_argument("--topic-option", action="append", default=[], type=_pair,
                               metavar="NAME=VALUE", help="of the broker; may be given more than once")
        streaming.add_argument("--checkpoint", required=True)
        streaming.add_argument("--trigger", default=TRIGGER)
        streaming.add_argument("--available-now", action="store_true")
    for reading in (consumer, state):
        reading.add_argument("--max-offsets", type=int, help="of a batch (kafka)")
        reading.add_argument("--min-partitions", type=int, help="tasks that read a batch (kafka)")
        reading.add_argument("--max-files", type=int, help="of a batch (file)")

    compact = jobs.add_parser("compact")
    stored = compact.add_mutually_exclusive_group(required=True)
    stored.add_argument("--history")
    stored.add_argument("--state")
    compact.add_argument("--buckets", type=int, help="of a history's latest rows; by default as many as shuffle partitions")
    compact.add_argument("--keep", action="store_true",
                         help="do not delete the history epochs that an older generation holds")

    metrics = jobs.add_parser("metrics", help="a row for every batch that was stored")
    logs = metrics.add_mutually_exclusive_group(required=True)
    logs.add_argument("--history")
    logs.add_argument("--state")
    metrics.add_argument("--output", required=True)

    refresh = jobs.add_parser("refresh", help="keep the joined view up to date")
    refresh.add_argument("--history", required=True)
    refresh.add_argument("--view", required=True)
    refresh.add_argument("--buckets", type=int, default=BUCKETS, help="fixed at the first refresh")
    refresh.add_argument("--compact-every", type=int, default=COMPACT_REFRESHES, metavar="REFRESHES")

    snapshot = jobs.add_parser("snapshot")
    snapshot.add_argument("--history", required=True)
    status = jobs.add_parser("status")
    status.add_argument("--history")
    status.add_argument("--state")
    status.add_argument("--checkpoint", help="of the state job")
    status.add_argument("--view", help="folder that the refresh job keeps")
    _database_arguments(status)
    reading = status.add_mutually_exclusive_group()
    reading.add_argument("--jdbc-view", help="the database's own joined view, read as it is")
    reading.add_argument("--jdbc-key-hash", metavar="SQL",
                         help="hash of a text column {key}, to read histories by in parallel; known for PostgreSQL and MySQL")
    for batch in (snapshot, status):
        batch.add_argument("--output", required=True)
        batch.add_argument("--snapshot", help="folder of an earlier snapshot")
        batch.add_argument("--one-pass", action="store_true",
                           help="nearly as many keys as rows: sort instead of scanning twice")

    views = jobs.add_parser("views")
    views.add_argument("--database", required=True)

    args = parser.parse_args(argv)
    _check(parser, args)
    return args


def _check(parser, args):
    """Refuse combinations in which an option would have no effect."""
    if args.job == "status":
        sources = [s for s in ("history", "state", "view", "checkpoint", "database", "jdbc_url")
                   if getattr(args, s)]
        if len(sources) != 1:
            parser.error("name one of --history, --state, --view, --checkpoint, --database, --jdbc-url")
        if args.snapshot and not args.history:
            parser.error("--snapshot goes with --history")
        if args.one_pass and not (args.history or args.database):
            parser.error("only --history and --database can be read in two passes")
        if (args.jdbc_view or args.jdbc_key_hash) and not args.jdbc_url:
            parser.error("--jdbc-view and --jdbc-key-hash go with --jdbc-url")
    if args.job == "state" and args.compact_every and not args.state:
        parser.error("--compact-every is for the change log of --state")
    if args.job == "compact" and (args.keep or args.buckets) and args.state:
        parser.error("--state always drops what is old, and has no buckets")
    if args.job == "ingest":
        if args.topic == STATIONS and not args.stage_scales:
            parser.error("stations need --stage-scales")
        if args.topic == MEASUREMENTS and (args.stage_scales or args.scales_fetched_at or args.strict):
            parser.error("--stage-scales, --scales-fetched-at and --strict are for stations")
    if args.job == "consume":
        others = [o for o in ("jdbc_url", "keyspace", "database") if getattr(args, o)]
        if not others and not args.history:
            parser.error("name at least one of --history, --jdbc-url, --keyspace, --database")
        if others and not args.rejects:
            parser.error("--rejects names a folder for what these targets cannot hold")
        if args.rejects and not others:
            parser.error("--history holds its rejects itself")
    if hasattr(args, "topics"):
        kind, place = args.topics
        limits = {n: getattr(args, n, None) for n in ("max_offsets", "min_partitions", "max_files")}
        if kind == "kafka":
            if limits["max_files"] and args.job != "ingest":
                parser.error("--max-files is for file topics")
            args.topics = KafkaTopics(place, limits["max_offsets"], limits["min_partitions"],
                                      dict(args.topic_option))
        else:
            if limits["max_offsets"] or limits["min_partitions"] or args.topic_option:
                parser.error("--max-offsets, --min-partitions and --topic-option are for kafka topics")
            args.topics = FileTopics(place, None if args.job == "ingest" else limits["max_files"])


def _jdbc(args):
    return JdbcTarget(args.jdbc_url, args.jdbc_driver, os.environ.get("JDBC_USER"),
                      os.environ.get("JDBC_PASSWORD"), args.jdbc_schema, args.connections)


def _sink(args, topic):
    sinks = []
    if args.history:
        sinks.append(HistorySink(f"{args.history}/{topic}", topic))
    if args.jdbc_url:
        sinks.append(JdbcSink(_jdbc(args), topic, f"{args.rejects}/jdbc/{topic}"))
    if args.keyspace:
        sinks.append(WideColumnSink(KeyspaceTarget(args.keyspace), topic, f"{args.rejects}/keyspace/{topic}"))
    if args.database:
        sinks.append(TableSink(args.database, topic, f"{args.rejects}/database/{topic}"))
    return sinks[0] if len(sinks) == 1 else fan_out(*sinks)


def _documents(spark, args):
    on_bad = "keep" if args.keep_bad else "fail"
    if not args.max_files and not args.max_bytes:
        args.max_bytes = _bytes(MAX_BATCH)
    bounds = {"maxFilesPerTrigger": args.max_files, "maxBytesPerTrigger": args.max_bytes}
    options = {name: str(value) for name, value in bounds.items() if value}
    if args.items:
        return read_items(spark, args.documents, True, on_bad, args.fetched_at, options)
    return read_documents(spark, args.documents, True, not args.lines, on_bad, args.fetched_at, options)


def run_ingest(spark, args):
    wanted = dict(args.match)
    scales = None
    if args.topic == STATIONS:
        scales = StageScales(spark, args.stage_scales, f"{args.checkpoint}/stage-scales",
                             multi_line=not (args.lines or args.items), fetched_at=args.scales_fetched_at)

    def output(batch, found=None):
        if args.topic == MEASUREMENTS:
            return measurement_output(batch, wanted, args.key)
        return station_output(batch, found, wanted, args.key, args.strict)

    await_all([consume(_documents(spark, args), args.topic, to_topics(args.topics, output, scales),
                       args.checkpoint, args.trigger, args.available_now)])


def run_consume(spark, args):
    sinks = {topic: _sink(args, topic) for topic in (STATIONS, MEASUREMENTS)}
    if args.database:
        create_tables(spark, args.database)
    await_all(start_topics(spark, args.topics, sinks, args.checkpoint, trigger=args.trigger,
                           available_now=args.available_now))


def run_state(spark, args):
    await_all([
        start_latest_state(spark, args.topics, topic, args.state and f"{args.state}/{topic}",
                           f"{args.checkpoint}/{topic}", args.trigger, args.available_now,
                           args.partitions, args.compact_every or COMPACT_EVERY)
        for topic in (STATIONS, MEASUREMENTS)
    ])


def run_compact(spark, args):
    for topic in (STATIONS, MEASUREMENTS):
        if args.state:
            compact_state(spark, f"{args.state}/{topic}", topic)
        else:
            compact_current(spark, f"{args.history}/{topic}", topic, args.buckets, two_pass_by_date, not args.keep)


def run_metrics(spark, args):
    both = [read_metrics(spark, f"{args.history or args.state}/{topic}") for topic in (STATIONS, MEASUREMENTS)]
    both[0].unionByName(both[1]).write.mode("overwrite").parquet(args.output)


def run_refresh(spark, args):
    histories = {topic: f"{args.history}/{topic}" for topic in (STATIONS, MEASUREMENTS)}
    JoinedView(spark, histories, args.view, args.buckets, args.compact_every).refresh()


def _form(args):
    return latest_by_key if args.one_pass else two_pass_by_date


def run_snapshot(spark, args):
    for topic in (STATIONS, MEASUREMENTS):
        write_snapshot(spark, f"{args.history}/{topic}", topic, f"{args.output}/{topic}",
                       args.snapshot and f"{args.snapshot}/{topic}", _form(args))


def _joined(spark, args):
    topics = (STATIONS, MEASUREMENTS)
    if args.view:
        return JoinedView(spark, {}, args.view).read()
    if args.checkpoint:
        return join_current(*[read_checkpoint(spark, f"{args.checkpoint}/{t}", t) for t in topics])
    if args.state:
        return join_current(*[read_state(spark, f"{args.state}/{t}", t) for t in topics])
    if args.history:
        return join_current(*[
            current_rows(spark, f"{args.history}/{t}", t, args.snapshot and f"{args.snapshot}/{t}", _form(args))
            for t in topics])
    if args.database:
        histories = [spark.table(f"{args.database}.{t}") for t in topics]
    else:
        if args.jdbc_view:
            return read_jdbc(spark, _jdbc(args), args.jdbc_view).select(*JOINED_COLUMNS)
        # One pass: a second one would have the database send its histories again.
        return stations_measurements(*[
            read_jdbc_history(spark, _jdbc(args), t, key_hash=args.jdbc_key_hash) for t in topics])
    return stations_measurements(*histories, latest=_form(args))


def run_status(spark, args):
    map_rows(_joined(spark, args)).write.mode("overwrite").parquet(args.output)


def run_views(spark, args):
    create_tables(spark, args.database)
    create_views(spark, args.database)


JOBS = {
    "ingest": run_ingest,
    "consume": run_consume,
    "state": run_state,
    "compact": run_compact,
    "metrics": run_metrics,
    "refresh": run_refresh,
    "snapshot": run_snapshot,
    "status": run_status,
    "views": run_views,
}


def main(argv=None, spark=None):
    args = _arguments(argv)
    spark = spark or build_session()
    spark.streams.addListener(BatchLog())
    JOBS[args.job](spark, args)


if __name__ == "__main__":
    main()
