"""Every registered query against its SQL, and the plans of the batch queries."""

import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from gaugewright.registry import batch, fixtures, oracle, streams
from gaugewright.schemas import MEASUREMENTS, STATIONS
from gaugewright.sources.epochs import open_log
from tests.compare import differences, duck, write_skewed
from tests.conftest import plan

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duckdb_tables():
    return duck(SF_DIR)


QUERIES = {**batch.QUERIES, **streams.QUERIES}


@pytest.mark.parametrize("name", sorted(oracle.ORACLES))
def test_query_equals_sql(spark, duckdb_tables, name):
    result = QUERIES[name](spark, SF_DIR)
    assert differences(result, duckdb_tables, oracle.ORACLES[name]) is None


@pytest.fixture(scope="module")
def skewed_dir(tmp_path_factory):
    target = str(tmp_path_factory.mktemp("skewed"))
    write_skewed(SF_DIR, target)
    return target


@pytest.mark.parametrize("name", sorted(batch.QUERIES))
def test_query_equals_sql_on_hot_keys_copies_and_nulls(spark, skewed_dir, name):
    result = batch.QUERIES[name](spark, skewed_dir)
    assert differences(result, duck(skewed_dir), oracle.ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle.ORACLES)
    assert set(QUERIES) <= set(driver.queries()) and set(oracle.ORACLES) <= set(driver.oracle_sql())


def test_random_ids_differ_each_time(spark):
    from gaugewright.functions.text import random_id

    ids = [{r["id"] for r in spark.range(100).select(random_id().alias("id")).collect()} for _ in "ab"]
    assert len(ids[0]) == len(ids[1]) == 100 and not ids[0] & ids[1]


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(batch.QUERIES))
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    text = plan(batch.QUERIES[name](spark, SF_DIR))
    for unwanted in ("PythonUDF", "ArrowEval", "BatchEvalPython", "CartesianProduct",
                     "BroadcastNestedLoopJoin"):
        assert unwanted not in text
    # A runtime filter is gathered from one array of a fixed size for each task; nothing else is.
    assert text.count("SinglePartition") <= text.count("[bloom_filter_agg(")


def test_status_sorts_only_what_is_latest(spark):
    """Two hash-aggregated maxima first; what is sorted has met the semi join."""
    text = plan(batch.status(spark, SF_DIR))
    for node in re.split(r"\n\n+", text[:text.index("\n\n\n")] if "\n\n\n" in text else text):
        lines = node.split("\n")
        for at, line in enumerate(lines):
            if "SortAggregate" in line and "Exchange" not in lines[at - 1]:
                below = "\n".join(lines[at + 1:at + 5])
                assert "BroadcastHashJoin LeftSemi" in below or "Exchange" in below, below
    assert "BroadcastHashJoin LeftSemi" in text


def test_scans_read_only_the_needed_columns(spark):
    text = plan(batch.latest_joined(spark, SF_DIR))
    events = next(s for s in re.findall(r"ReadSchema: struct<(.*?)>", text) if "ts:" in s)
    assert "props" not in events and "event_type" in events
    assert "IsNotNull(ts)" in text


def test_entry_without_the_training_data_operators():
    """The driver's file imports, and has all other queries, where those were left out."""
    import subprocess
    import sys

    code = ("import sys; sys.modules['gaugewright.llm'] = sys.modules['corpus_pipeline'] = None\n"
            "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))")
    root = os.path.dirname(os.path.abspath(driver.__file__))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(QUERIES)), str(len(oracle.ORACLES))]


@pytest.mark.parametrize("name", ["latest_state_stream", "status_from_state", "status_from_checkpoint"])
def test_state_queries_run_on_a_cluster(spark, duckdb_tables, monkeypatch, name):
    """A cluster's master does not say how many state partitions there should be."""
    monkeypatch.setattr(spark.sparkContext, "master", "spark://host:7077")
    result = QUERIES[name](spark, SF_DIR)
    assert differences(result, duckdb_tables, oracle.ORACLES[name]) is None


@pytest.fixture(scope="module")
def one_group_dir(spark, tmp_path_factory):
    """Tables of one row group each."""
    target = str(tmp_path_factory.mktemp("one-group"))
    n = F.col("id")
    spark.range(2000).coalesce(1).select(
        n.alias("event_id"), F.timestamp_seconds(1704067200 + n).cast("timestamp_ntz").alias("ts"), (n % 50).alias("user_id"),
        F.when(n % 7 > 0, "click").otherwise("error").alias("event_type"), (n / 8).alias("value"),
    ).write.parquet(f"{target}/events.parquet")
    spark.range(300).coalesce(1).select(
        n.alias("c_custkey"), F.concat(F.lit("Customer "), n).alias("c_name"), (n % 25).cast("int").alias("c_nationkey"),
        F.lit("BUILDING").alias("c_mktsegment")).write.parquet(f"{target}/customer.parquet")
    spark.range(50).coalesce(1).select(
        n.alias("s_suppkey"), (n % 25).cast("int").alias("s_nationkey"), (n * 3.5).alias("s_acctbal"),
    ).write.parquet(f"{target}/supplier.parquet")
    spark.range(40).coalesce(1).select(
        n.alias("doc_id"), F.concat(F.lit("prose "), n).alias("text")).write.parquet(f"{target}/documents.parquet")
    return target


def _even(rows, tasks):
    counts = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    return len(counts) >= tasks and max(counts) < 2 * min(counts)


def test_documents_of_one_row_group_are_built_by_all_cores(spark, one_group_dir):
    tasks = spark.sparkContext.defaultParallelism
    assert _even(fixtures.measurement_document_texts(spark, one_group_dir), tasks)
    assert _even(fixtures.station_document_texts(spark, one_group_dir), tasks)


def test_a_batch_of_a_topic_is_as_many_files_as_cores(spark, one_group_dir, tmp_path):
    topics = streams._topics(spark, one_group_dir, str(tmp_path), STATIONS, MEASUREMENTS)
    for topic in (STATIONS, MEASUREMENTS):
        files = len(topics.read(spark, topic).inputFiles())
        assert topics.max_files >= spark.sparkContext.defaultParallelism
        assert files == streams.BATCHES * topics.max_files
    streams._consume(spark, topics, str(tmp_path), MEASUREMENTS)
    assert len(open_log(spark, f"{tmp_path}/history/{MEASUREMENTS}").epochs) == streams.BATCHES


def test_rejects_come_in_as_many_files_as_cores(spark, one_group_dir, monkeypatch):
    written = []
    write = streams.FileTopics.write

    def noted(topics, messages, topic):
        written.append(messages.rdd.getNumPartitions())
        write(topics, messages, topic)

    monkeypatch.setattr(streams.FileTopics, "write", noted)
    rows = streams.rejects_stream(spark, one_group_dir)
    assert rows.count() == 40 and min(written) >= streams.BATCHES * spark.sparkContext.defaultParallelism


def test_station_documents_are_parsed_once_for_all_refreshes(spark, one_group_dir, monkeypatch):
    sources = []
    save = batch.HistorySink.__call__

    def noted(sink, messages, run, epoch):
        if sink.topic == STATIONS:
            sources.extend(messages.inputFiles())
        save(sink, messages, run, epoch)

    monkeypatch.setattr(batch.HistorySink, "__call__", noted)
    assert batch.status_incremental(spark, one_group_dir).count() > 0
    assert sources and not [s for s in sources if "customer.parquet" in s]
