"""Targets that need a server: options and rows are checked, nothing is sent."""

import pytest

from gaugewright.plans.views import create_views, latest_measurements
from gaugewright.schemas import (
    LATEST_STATIONS_COLUMNS,
    MEASUREMENTS,
    RELATIONAL,
    STATIONS,
    WIDE_COLUMN,
    create_tables,
    table_schema,
)
from gaugewright.session import clean_work, shared_folder, work_database, work_path
from gaugewright.sinks.history import TableSink
from gaugewright.sinks.relational import JdbcSink, JdbcTarget
from gaugewright.sinks.wide_column import KeyspaceTarget, WideColumnSink
from gaugewright.sources.history import key_conditions, read_jdbc, read_jdbc_history, read_rejects
from gaugewright.sources.topics import FileTopics, KafkaTopics

TEXT = '{"id":"a","value":0.5,"last_update":"2024-01-01 00:00:00.000000"}'


def test_kafka_options():
    topics = KafkaTopics("broker:9092", max_offsets=1000, min_partitions=64,
                         extra={"kafka.security.protocol": "PLAINTEXT"})
    assert topics.options("stations") == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "stations",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "1000", "minPartitions": "64",
        "kafka.security.protocol": "PLAINTEXT"}
    assert topics.write_options()["kafka.bootstrap.servers"] == "broker:9092"


def test_jdbc_options_and_rows(spark):
    target = JdbcTarget("jdbc:postgresql://db/levels", "org.postgresql.Driver", "u", "p",
                        schema="monitoring", connections=16)
    assert target.write_options("stations") == {
        "url": "jdbc:postgresql://db/levels", "driver": "org.postgresql.Driver",
        "dbtable": "monitoring.stations", "user": "u", "password": "p",
        "batchsize": "10000", "numPartitions": "16"}
    assert target.read_options("stationsmeasurements")["dbtable"] == (
        "monitoring.stationsmeasurements")
    messages = spark.createDataFrame([(TEXT,), ("broken",)], "value string")
    rows = JdbcSink(target, MEASUREMENTS, "rejects").rows(messages)
    assert rows.columns == ["id", "stationreference", "datetime", "value", "unit", "last_update"]
    assert rows.count() == 1 and dict(rows.dtypes)["value"] == "double"


def test_jdbc_reads_are_split():
    class Reader:
        def __init__(self):
            self.read, self.given = self, None

        def format(self, name):
            return self

        def options(self, **given):
            self.given = given
            return self

        def load(self):
            return self.given

        def jdbc(self, url, table, predicates, properties):
            return {"url": url, "table": table, "predicates": predicates, **properties}

    target = JdbcTarget("jdbc:postgresql://db/levels", "org.postgresql.Driver")
    given = read_jdbc(Reader(), target, "measurements", ("PK_ID", 1, 10**9, 64))
    assert given["partitionColumn"] == "PK_ID" and given["numPartitions"] == "64"
    assert "partitionColumn" not in read_jdbc(Reader(), target, "measurements")
    # A history is split by its key's hash, and never read whole by one task.
    given = read_jdbc_history(Reader(), target, "measurements", 3)
    assert given == {
        "url": target.url, "table": "measurements", "driver": target.driver, "fetchsize": "10000",
        "predicates": [f'(hashtext("ID") & 2147483647) % 3 = {part}' for part in range(3)]}
    assert len(read_jdbc_history(Reader(), target, "stations")["predicates"]) == target.connections
    assert key_conditions("jdbc:mysql://db/x", "id", 1) == ["crc32(`ID`) % 1 = 0"]
    assert key_conditions("jdbc:other:x", "id", 2, "h({key})") == ["h(ID) % 2 = 0", "h(ID) % 2 = 1"]
    with pytest.raises(ValueError, match="one task"):
        key_conditions("jdbc:other:x", "id", 2)


def test_wide_column_options_and_rows(spark):
    target = KeyspaceTarget("monitoring", {"spark.cassandra.connection.host": "db"})
    assert target.options("stations") == {
        "keyspace": "monitoring", "table": "stations", "spark.cassandra.connection.host": "db"}
    rows = WideColumnSink(target, MEASUREMENTS, "rejects").rows(
        spark.createDataFrame([(TEXT,)], "value string"))
    assert rows.columns == ["uuid", "id", "stationreference", "datetime", "value", "unit"]


def test_topics_written_by_name(spark, tmp_path):
    topics = FileTopics(str(tmp_path))
    topics.write_all(spark.createDataFrame(
        [("stations", "k", "1"), ("other", "k", "2")], "topic string, key string, value string"))
    topics.write(spark.createDataFrame([("k", "3")], "key string, value string"), "stations")
    assert sorted(r["value"] for r in topics.read(spark, "stations").collect()) == ["1", "3"]
    assert topics.read(spark, "other").count() == 1


def test_tables_are_created_by_date(spark, tmp_path):
    create_tables(spark, "levels", str(tmp_path / "levels"))
    for topic in (STATIONS, MEASUREMENTS):
        table = spark.table(f"levels.{topic}")
        assert table.columns == table_schema(topic).names + ["ingest_date"]
    create_tables(spark, "wide", str(tmp_path / "wide"), WIDE_COLUMN)
    assert spark.table("wide.stations").columns == table_schema(STATIONS, WIDE_COLUMN).names


def test_table_sink_and_sql_views(spark, tmp_path):
    station = '{"rloiid":"s","measures_id":"a","last_update":"2024-01-01 00:00:00.000000"}'
    create_tables(spark, "gauges", str(tmp_path))
    for topic, text in ((STATIONS, station), (MEASUREMENTS, TEXT)):
        messages = spark.createDataFrame([(text,), ("broken",)], "value string")
        for _ in range(2):
            TableSink("gauges", topic, f"{tmp_path}/rejects/{topic}")(messages, "run", 0)
        [bad] = read_rejects(spark, f"{tmp_path}/rejects/{topic}", topic).collect()
        assert bad["reject_value"] == "broken"
    create_views(spark, "gauges")
    # The second call was a replay.
    assert spark.table("gauges.measurements").where("ingest_date = '2024-01-01'").count() == 1
    rows = spark.sql("SELECT * FROM gauges.stationsmeasurements").collect()
    assert [(r["station_id"], r["value"]) for r in rows] == [("s", 0.5)]
    assert spark.table("gauges.latest_stations").columns == LATEST_STATIONS_COLUMNS


@pytest.mark.parametrize("kind", [JdbcSink, WideColumnSink])
def test_sinks_keep_what_the_target_cannot_hold(spark, tmp_path, monkeypatch, kind):
    """Without a database: what would be sent is counted."""
    sent = []
    monkeypatch.setattr(kind, "_append", lambda self, messages: sent.append(self.rows(messages).count()))
    sink = kind(None, MEASUREMENTS, str(tmp_path / "rejects"))
    messages = spark.createDataFrame([(TEXT,), ("broken",), ("",)], "value string")
    for epoch in (0, 0, 1):
        sink(messages, "run", epoch)
    assert sent == [1, 1]
    kept = read_rejects(spark, str(tmp_path / "rejects"), MEASUREMENTS, sink_layout(kind)).collect()
    assert sorted((r["reject_value"], r["epoch"]) for r in kept) == [
        ("", 0), ("", 1), ("broken", 0), ("broken", 1)]


def sink_layout(kind):
    return WIDE_COLUMN if kind is WideColumnSink else RELATIONAL


def test_database_names_still_break_ties(spark):
    """PK_ID as the tables are declared in a database."""
    rows = spark.createDataFrame(
        [("1", "a", "2024-01-01", 1.0), ("2", "a", "2024-01-01", 2.0)],
        "PK_ID string, id string, last_update string, value double").repartition(2)
    [row] = latest_measurements(rows, columns=["id", "value"]).collect()
    assert row["value"] == 2.0


def test_unknown_table_is_an_error(spark):
    with pytest.raises(ValueError, match="tides"):
        table_schema("tides")


def test_work_paths_lie_in_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert shared_folder(spark) == folder.rstrip("/")
    one, two = work_path(spark, "x"), work_path(spark, "x")
    assert one != two and one.startswith(folder)


def test_work_is_cleaned_up(spark):
    import os

    path = work_path(spark, "kept")
    spark.range(3).write.parquet(path)
    spark.sql(f"CREATE DATABASE {work_database('once_only')}")
    clean_work(spark)
    assert not os.path.exists(path)
    assert "once_only" not in [d.name for d in spark.catalog.listDatabases()]
