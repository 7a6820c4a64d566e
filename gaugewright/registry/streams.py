"""Streaming queries: each writes the messages to a topic, consumes it, and reads the result."""

from pyspark.sql import functions as F

from gaugewright.functions.times import utc_wall_clock
from gaugewright.plans.ingest import (
    REJECTS_SUFFIX,
    measurement_messages,
    measurement_output,
    station_messages,
    station_output,
)
from gaugewright.plans.scales import StageScales
from gaugewright.plans.status import map_rows, station_status
from gaugewright.plans.views import join_current, latest_measurements
from gaugewright.registry.fixtures import (
    cores,
    land_measurement_documents,
    measurement_documents,
    stage_scale_lines,
    stage_scales,
    station_documents,
    station_lines,
    table,
)
from gaugewright.schemas import MEASUREMENTS, STATIONS
from gaugewright.session import work_path
from gaugewright.sinks.history import HistorySink
from gaugewright.sources.documents import read_documents
from gaugewright.sources.epochs import read_metrics
from gaugewright.sources.history import read_history, read_rejects
from gaugewright.sources.topics import FileTopics
from gaugewright.streaming.consume import await_all, consume, start_topics, to_topics
from gaugewright.streaming.state import read_checkpoint, read_state, start_latest_state

# Each topic is consumed in this many micro-batches.
BATCHES = 5


def _zone_less(df, *columns):
    return df.withColumns({c: utc_wall_clock(df, c) for c in columns})


def _topics(spark, sf_dir, base, *wanted):
    """Topics whose messages come in several batches, in no order of time. A batch takes a file per core."""
    topics = FileTopics(f"{base}/topics", max_files=cores(spark))
    files = BATCHES * cores(spark)
    if MEASUREMENTS in wanted:
        messages = measurement_messages(measurement_documents(spark, sf_dir))
        topics.write(messages.repartition(files, F.xxhash64("value")), MEASUREMENTS)
    if STATIONS in wanted:
        messages = station_messages(station_documents(spark, sf_dir), stage_scales(spark, sf_dir))
        topics.write(messages.repartition(files, F.xxhash64("value")), STATIONS)
    return topics


def _consume(spark, topics, base, *wanted):
    sinks = {topic: HistorySink(f"{base}/history/{topic}", topic) for topic in wanted}
    await_all(start_topics(spark, topics, sinks, f"{base}/checkpoints", available_now=True))
    return [read_history(spark, sinks[topic].path, topic) for topic in wanted]


def ingest_stream(spark, sf_dir):
    """A landing folder followed as a stream, a file per batch: documents in, messages out."""
    base = work_path(spark, "ingest-stream")
    land_measurement_documents(spark, sf_dir, f"{base}/landing", BATCHES)
    documents = read_documents(
        spark, f"{base}/landing", stream=True, multi_line=False, fetched_at="fetched",
        options={"maxFilesPerTrigger": "1"},
    )
    topics = FileTopics(f"{base}/topics")
    await_all([consume(documents, "ingest", to_topics(topics, measurement_output),
                       f"{base}/checkpoint", available_now=True)])
    return topics.read(spark, MEASUREMENTS)


def station_ingest_stream(spark, sf_dir):
    """Station documents and their stage scales land between batches; a batch is joined with the
    scales that are there, of which only the new files are read."""
    base = work_path(spark, "station-ingest")
    topics = FileTopics(f"{base}/topics")
    for part in range(3):
        nation = F.col("nation") % 3 == part
        stage_scale_lines(spark, sf_dir).where(nation).select("value").write.mode("append").text(
            f"{base}/scales")
        station_lines(spark, sf_dir).where(nation).select("value").write.mode("append").text(
            f"{base}/landing")
        documents = read_documents(
            spark, f"{base}/landing", stream=True, multi_line=False, fetched_at="fetched")
        # As a new process would: what it has seen is in the table's folder.
        scales = StageScales(spark, f"{base}/scales", f"{base}/table", multi_line=False, fetched_at="fetched")
        sink = to_topics(topics, station_output, scales)
        await_all([consume(documents, "station-ingest", sink, f"{base}/checkpoint",
                           available_now=True)])
    return topics.read(spark, STATIONS).withColumn("topic", F.lit(STATIONS)).unionByName(
        topics.read(spark, STATIONS + REJECTS_SUFFIX).withColumn(
            "topic", F.lit(STATIONS + REJECTS_SUFFIX)))


def history_stream(spark, sf_dir):
    """The history a stream leaves behind."""
    base = work_path(spark, "history-stream")
    [history] = _consume(spark, _topics(spark, sf_dir, base, MEASUREMENTS), base, MEASUREMENTS)
    return _zone_less(history, "datetime", "last_update").drop("pk_id", "sequence")


def latest_measurements_stream(spark, sf_dir):
    """The view over a streamed history."""
    base = work_path(spark, "latest-stream")
    [history] = _consume(spark, _topics(spark, sf_dir, base, MEASUREMENTS), base, MEASUREMENTS)
    return _zone_less(latest_measurements(history), "datetime", "last_update")


def latest_state_stream(spark, sf_dir):
    """The same rows from streaming state instead of the history."""
    base = work_path(spark, "state-stream")
    topics = _topics(spark, sf_dir, base, MEASUREMENTS)
    query = start_latest_state(
        spark, topics, MEASUREMENTS, f"{base}/state", f"{base}/checkpoint", available_now=True,
        partitions=cores(spark), compact_every=2,
    )
    await_all([query])
    current = latest_measurements(read_state(spark, f"{base}/state", MEASUREMENTS))
    return _zone_less(current, "datetime", "last_update")


def status_from_state(spark, sf_dir):
    """The status of every station from the streaming state of both topics."""
    base = work_path(spark, "state-status")
    topics = _topics(spark, sf_dir, base, STATIONS, MEASUREMENTS)
    wanted = (STATIONS, MEASUREMENTS)
    await_all([
        start_latest_state(spark, topics, topic, f"{base}/state/{topic}",
                           f"{base}/checkpoints/{topic}", available_now=True,
                           partitions=cores(spark), compact_every=2)
        for topic in wanted
    ])
    return map_rows(join_current(*[
        read_state(spark, f"{base}/state/{topic}", topic) for topic in wanted
    ]))


def status_from_checkpoint(spark, sf_dir):
    """The same without a change log: both topics' rows are read out of the queries' state."""
    base = work_path(spark, "checkpoint-status")
    topics = _topics(spark, sf_dir, base, STATIONS, MEASUREMENTS)
    wanted = (STATIONS, MEASUREMENTS)
    await_all([
        start_latest_state(spark, topics, topic, None, f"{base}/checkpoints/{topic}", available_now=True,
                           partitions=cores(spark))
        for topic in wanted
    ])
    return map_rows(join_current(*[
        read_checkpoint(spark, f"{base}/checkpoints/{topic}", topic) for topic in wanted
    ]))


def status_stream(spark, sf_dir):
    """Both topics consumed side by side, then the status of every station."""
    base = work_path(spark, "status-stream")
    topics = _topics(spark, sf_dir, base, STATIONS, MEASUREMENTS)
    return station_status(*_consume(spark, topics, base, STATIONS, MEASUREMENTS))


def batch_metrics(spark, sf_dir):
    """What the sink noted of each batch as it wrote it; readings come with prose that is rejected."""
    base = work_path(spark, "batch-metrics")
    topics = FileTopics(f"{base}/topics")
    sink = HistorySink(f"{base}/history", MEASUREMENTS)
    prose = table(spark, sf_dir, "documents")
    documents = measurement_documents(spark, sf_dir)
    for part in range(BATCHES):
        messages = measurement_messages(documents.where(F.dayofmonth("fetched_at") % BATCHES == part))
        topics.write(messages, MEASUREMENTS)
        topics.write(prose.where(F.col("doc_id") % BATCHES == part).select(
            F.lit("k").alias("key"), F.col("text").alias("value")), MEASUREMENTS)
        await_all([consume(topics.read_stream(spark, MEASUREMENTS), MEASUREMENTS, sink, f"{base}/checkpoint",
                           available_now=True)])
    rows = _zone_less(read_metrics(spark, sink.path), "first_stamp", "last_stamp")
    return rows.drop("run", "attempt", "written_at")


def rejects_stream(spark, sf_dir):
    """Prose sent to a topic: kept aside by the sink, whole."""
    base = work_path(spark, "rejects-stream")
    topics = _topics(spark, sf_dir, base, MEASUREMENTS)
    prose = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("key"), F.col("text").alias("value")
    )
    topics.write(prose.repartition(BATCHES * cores(spark)), MEASUREMENTS)
    sink = HistorySink(f"{base}/history", MEASUREMENTS)
    await_all([consume(
        topics.read_stream(spark, MEASUREMENTS), MEASUREMENTS, sink, f"{base}/checkpoint",
        available_now=True,
    )])
    return read_rejects(spark, sink.path, MEASUREMENTS).drop("run", "epoch")


QUERIES = {
    "ingest_stream": ingest_stream,
    "station_ingest_stream": station_ingest_stream,
    "history_stream": history_stream,
    "latest_measurements_stream": latest_measurements_stream,
    "latest_state_stream": latest_state_stream,
    "status_from_state": status_from_state,
    "status_from_checkpoint": status_from_checkpoint,
    "status_stream": status_stream,
    "rejects_stream": rejects_stream,
    "batch_metrics": batch_metrics,
}
