import datetime
import json
import logging
from functools import partial

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gaugewright.functions.times import utc_date
from gaugewright.operators.decode import decode
from gaugewright.operators.latest import latest_by_key, latest_by_key_two_pass
from gaugewright.plans.current import compact_current, current_rows, two_pass_by_date, write_snapshot
from gaugewright.plans.views import latest_measurements, stations_measurements
from gaugewright.schemas import MEASUREMENTS, STATIONS, WIDE_COLUMN, table_schema
from gaugewright.sinks.history import HistorySink, compact_history, rewrite_by_date
from gaugewright.sources.clustered import forget_clustered
from gaugewright.sources.epochs import delete_folder, generations, open_log, record_path, write_epoch
from gaugewright.sources.history import read_dated, read_history, read_rejects, read_stored
from gaugewright.sources.topics import FileTopics
from gaugewright.streaming.consume import await_all, consume, fan_out, start_topics
from gaugewright.streaming.progress import BatchLog
from gaugewright.streaming.state import (
    compact_state, read_changes, read_checkpoint, read_state, start_latest_state,
)
from tests.conftest import plan


def message(key, value, minute=0):
    return json.dumps({"id": key, "value": value, "unit": "m",
                       "datetime": "2024-01-01T00:00:00Z",
                       "last_update": f"2024-01-01 00:{minute:02d}:00.000000"})


def send(spark, topics, *texts, topic=MEASUREMENTS):
    """One file, so that each call can become a batch of its own."""
    rows = spark.createDataFrame([("k", t) for t in texts], "key string, value string")
    topics.write(rows.coalesce(1), topic)


@pytest.fixture
def place(tmp_path):
    class Place:
        topics = FileTopics(str(tmp_path / "topics"), max_files=1)
        history = str(tmp_path / "history")
        checkpoint = str(tmp_path / "checkpoint")
        path = tmp_path

        def run(self, spark, sink=None, checkpoint=None):
            sink = sink or HistorySink(self.history, MEASUREMENTS)
            await_all([consume(self.topics.read_stream(spark, MEASUREMENTS), MEASUREMENTS, sink,
                               checkpoint or self.checkpoint, available_now=True)])

        def values(self, spark):
            rows = read_history(spark, self.history, MEASUREMENTS)
            return sorted(r["value"] for r in rows.collect())

        def latest(self, spark):
            view = latest_measurements(read_history(spark, self.history, MEASUREMENTS))
            return sorted((r["id"], r["value"]) for r in view.collect())

    return Place()


def test_batches_then_restart_reads_only_what_is_new(spark, place):
    send(spark, place.topics, message("a", 1.0))
    send(spark, place.topics, message("a", 2.0, 1), message("b", 3.0))
    place.run(spark)
    stored = read_stored(spark, place.history, MEASUREMENTS)
    assert stored.select("epoch").distinct().count() == 2
    send(spark, place.topics, message("c", 4.0))
    place.run(spark)
    assert place.values(spark) == [1.0, 2.0, 3.0, 4.0]
    assert place.latest(spark) == [("a", 2.0), ("b", 3.0), ("c", 4.0)]


def test_crash_after_write_leaves_no_duplicates(spark, place):
    send(spark, place.topics, message("a", 1.0), message("b", 2.0))
    sink = HistorySink(place.history, MEASUREMENTS)

    def crashing(messages, run, epoch):
        sink(messages, run, epoch)
        raise RuntimeError("lost after the write")

    with pytest.raises(StreamingQueryException):
        place.run(spark, crashing)
    assert place.values(spark) == [1.0, 2.0]
    place.run(spark)
    assert place.values(spark) == [1.0, 2.0]


def test_new_checkpoint_loses_nothing_and_the_view_hides_replays(spark, place):
    send(spark, place.topics, message("a", 1.0))
    send(spark, place.topics, message("b", 2.0))
    place.run(spark)
    send(spark, place.topics, message("c", 3.0))
    place.run(spark, checkpoint=str(place.path / "other"))
    assert place.values(spark) == [1.0, 1.0, 2.0, 2.0, 3.0]
    assert place.latest(spark) == [("a", 1.0), ("b", 2.0), ("c", 3.0)]


def test_wide_column_layout_is_stored_without_dates(spark, place):
    send(spark, place.topics, message("a", 1.0), "broken")
    place.run(spark, HistorySink(place.history, MEASUREMENTS, WIDE_COLUMN))
    [row] = read_history(spark, place.history, MEASUREMENTS, WIDE_COLUMN).collect()
    assert row["datetime"] == "2024-01-01T00:00:00Z" and row["ingest_date"] is None
    assert read_rejects(spark, place.history, MEASUREMENTS, WIDE_COLUMN).count() == 1


def test_out_of_order_messages(spark, place):
    send(spark, place.topics, message("a", 2.0, 9))
    send(spark, place.topics, message("a", 1.0, 3))
    place.run(spark)
    assert place.latest(spark) == [("a", 2.0)]


def test_rejects_are_stored_beside_the_history(spark, place):
    send(spark, place.topics, message("a", 1.0), "no json", "{}")
    place.run(spark)
    assert place.values(spark) == [1.0]
    rows = read_rejects(spark, place.history, MEASUREMENTS).collect()
    assert {(r["reject_reason"], r["reject_value"]) for r in rows} == {
        ("malformed message", "no json"), ("no known field", "{}")}


def test_history_without_stamp_is_kept(spark, place):
    send(spark, place.topics, '{"id":"a","value":1.0}')
    place.run(spark)
    assert place.values(spark) == [1.0] and place.latest(spark) == []


def test_two_topics_side_by_side(spark, place):
    station = json.dumps({"rloiid": "s", "measures_id": "a", "typicalrangelow": 0.5,
                          "last_update": "2024-01-01 00:00:00.000000"})
    send(spark, place.topics, station, topic=STATIONS)
    send(spark, place.topics, message("a", 1.0))
    sinks = {t: HistorySink(f"{place.history}/{t}", t) for t in (STATIONS, MEASUREMENTS)}
    await_all(start_topics(spark, place.topics, sinks, place.checkpoint, available_now=True))
    view = stations_measurements(*[read_history(spark, sinks[t].path, t)
                                   for t in (STATIONS, MEASUREMENTS)])
    assert [(r["station_id"], r["value"]) for r in view.collect()] == [("s", 1.0)]


def test_a_failing_query_stops_the_others(spark, place):
    send(spark, place.topics, message("a", 1.0))
    send(spark, place.topics, "{}", topic=STATIONS)

    def failing(messages, run, epoch):
        raise RuntimeError("sink is gone")

    sinks = {MEASUREMENTS: HistorySink(place.history, MEASUREMENTS), STATIONS: failing}
    queries = start_topics(spark, place.topics, sinks, place.checkpoint, trigger="1 second")
    with pytest.raises(StreamingQueryException, match="sink is gone"):
        await_all(queries)
    assert not any(q.isActive for q in queries)


def test_checkpoint_is_required(spark, place):
    with pytest.raises(ValueError, match="checkpoint"):
        consume(None, MEASUREMENTS, None, None)


def test_fan_out_hands_a_batch_to_every_sink(spark, place):
    send(spark, place.topics, message("a", 1.0), message("b", 2.0))
    seen = []
    place.run(spark, fan_out(HistorySink(place.history, MEASUREMENTS),
                             lambda messages, run, epoch: seen.append(messages.count())))
    assert seen == [2] and place.values(spark) == [1.0, 2.0]


def test_state_follows_out_of_order_and_tied_messages_over_restarts(spark, place):
    state, checkpoint = str(place.path / "state"), str(place.path / "state-checkpoint")

    def run():
        await_all([start_latest_state(spark, place.topics, MEASUREMENTS, state, checkpoint,
                                      available_now=True)])
        rows = read_state(spark, state, MEASUREMENTS).collect()
        return sorted((r["id"], r["value"]) for r in rows)

    send(spark, place.topics, message("a", 1.0, 5), message("b", 1.0, 5))
    send(spark, place.topics, message("a", 2.0, 3))
    assert run() == [("a", 1.0), ("b", 1.0)]
    send(spark, place.topics, message("a", 3.0, 7), message("b", 1.0, 5), "broken")
    assert run() == [("a", 3.0), ("b", 1.0)]
    place.run(spark)
    assert place.latest(spark) == [("a", 3.0), ("b", 1.0)]
    compact_state(spark, state, MEASUREMENTS)
    current = read_state(spark, state, MEASUREMENTS)
    assert current.columns == table_schema(MEASUREMENTS).names
    rows = current.collect()
    assert sorted((r["id"], r["value"]) for r in rows) == [("a", 3.0), ("b", 1.0)]

    # The query goes on beside the compacted log.
    send(spark, place.topics, message("b", 5.0, 9))
    assert run() == [("a", 3.0), ("b", 5.0)]


def test_state_is_read_out_of_the_checkpoint(spark, place):
    checkpoint = str(place.path / "state-checkpoint")

    def run():
        await_all([start_latest_state(spark, place.topics, MEASUREMENTS, None, checkpoint, available_now=True)])
        return sorted((r["id"], r["value"]) for r in read_checkpoint(spark, checkpoint, MEASUREMENTS).collect())

    send(spark, place.topics, message("a", 1.0, 5), message("b", 1.0, 5))
    send(spark, place.topics, message("a", 2.0, 3))
    assert run() == [("a", 1.0), ("b", 1.0)]
    send(spark, place.topics, message("a", 3.0, 7), message("c", 1.0, 5), "broken")
    assert run() == [("a", 3.0), ("b", 1.0), ("c", 1.0)]
    rows = read_checkpoint(spark, checkpoint, MEASUREMENTS)
    assert rows.schema.names == table_schema(MEASUREMENTS).names
    assert [f.dataType for f in rows.schema] == [f.dataType for f in table_schema(MEASUREMENTS)]
    place.run(spark)
    whole = latest_by_key(read_history(spark, place.history, MEASUREMENTS), "id", "last_update", ["sequence", "pk_id"], rows.columns)
    assert sorted(map(str, rows.collect())) == sorted(map(str, whole.collect()))
    earlier = read_checkpoint(spark, checkpoint, MEASUREMENTS, batch=0)
    assert sorted((r["id"], r["value"]) for r in earlier.collect()) == [("a", 1.0), ("b", 1.0)]
    text = plan(rows)
    assert "Exchange" not in text and "Sort" not in text
    with pytest.raises(ValueError, match="no current rows of stations"):
        read_checkpoint(spark, checkpoint, STATIONS)


def test_the_state_log_stays_as_short_as_its_keys(spark, place):
    state, checkpoint = str(place.path / "state"), str(place.path / "state-checkpoint")
    for minute in range(12):
        send(spark, place.topics, *[message(key, float(minute), minute) for key in "abcd"])
    await_all([start_latest_state(spark, place.topics, MEASUREMENTS, state, checkpoint,
                                  available_now=True, compact_every=3)])
    log = open_log(spark, state)
    assert len(log.epochs) == 12 and len(log.added) == 0
    assert read_changes(spark, state, MEASUREMENTS).count() == 4
    assert {r["value"] for r in read_state(spark, state, MEASUREMENTS).collect()} == {11.0}
    assert len(generations(spark, state)) == 1 and len(log.recorded) == 3
    # A replayed epoch is known already.
    rows = read_changes(spark, state, MEASUREMENTS)
    run, epoch = max(log.recorded)
    write_epoch(rows, state, run, epoch)
    assert open_log(spark, state).added == {}


def test_a_cluster_must_name_its_state_partitions(spark, place, monkeypatch):
    class Session:
        sparkContext = type("Context", (), {"master": "yarn"})

    with pytest.raises(ValueError, match="partitions"):
        start_latest_state(Session(), place.topics, MEASUREMENTS, "s", "c")


def test_a_large_date_is_rewritten_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 200_000, numPartitions=8).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
        F.when(F.col("id") % 100 > 0, "2024-01-01").otherwise("2024-01-02").cast("date")
        .alias("ingest_date"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        rewrite_by_date(rows, str(tmp_path / "dates"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {d: len(list((tmp_path / "dates" / f"ingest_date=2024-01-0{d}").glob("*.parquet")))
             for d in (1, 2)}
    assert files[1] > 2 and files[2] == 1
    assert spark.read.parquet(str(tmp_path / "dates")).count() == 200_000


def test_dates_are_read_selectively_and_rewritten(spark, place):
    later = message("b", 2.0).replace("2024-01-01 00", "2024-01-02 00")
    send(spark, place.topics, message("a", 1.0), later)
    place.run(spark)
    recent = read_history(spark, place.history, MEASUREMENTS, since="2024-01-02")
    assert [r["id"] for r in recent.collect()] == ["b"]
    text = recent._jdf.queryExecution().executedPlan().toString()
    assert "ingest_date" in text.split("PartitionFilters")[1].split("]")[0]
    target = str(place.path / "dates")
    rewrite_by_date(read_history(spark, place.history, MEASUREMENTS), target)
    dated = read_dated(spark, target, MEASUREMENTS)
    assert [r["id"] for r in dated.where("ingest_date = '2024-01-02'").collect()] == ["b"]
    assert dated.count() == 2


def test_ingest_date_is_utc_in_any_session(spark):
    rows = decode(spark.createDataFrame([(message("a", 1.0),)], "value string"), MEASUREMENTS)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        day = rows.select(utc_date("last_update").alias("d")).first()["d"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert day == datetime.date(2024, 1, 1)


def test_batches_are_logged(spark, place, caplog):
    send(spark, place.topics, message("a", 1.0))
    listener = BatchLog()
    spark.streams.addListener(listener)
    try:
        with caplog.at_level(logging.INFO, logger="gaugewright"):
            place.run(spark)
    finally:
        spark.streams.removeListener(listener)
    assert "epoch 0: saved messages of topic measurements" in caplog.text


def test_a_snapshot_takes_in_rows_that_came_late(spark, place):
    """``late`` is stamped before everything in the snapshot, but consumed after it."""
    day = message("a", 2.0).replace("2024-01-01 00", "2024-01-05 00")
    send(spark, place.topics, message("a", 1.0, 9), message("b", 1.5, 3))
    place.run(spark)
    first, second = str(place.path / "first"), str(place.path / "second")
    write_snapshot(spark, place.history, MEASUREMENTS, first)
    send(spark, place.topics, day, message("late", 7.0, 0).replace("2024-01-01 00", "2023-12-01 00"))
    place.run(spark)
    expected = [("a", 2.0), ("b", 1.5), ("late", 7.0)]
    for form in (latest_by_key, two_pass_by_date):
        rows = current_rows(spark, place.history, MEASUREMENTS, first, form)
        assert sorted((r["id"], r["value"]) for r in rows.collect()) == place.latest(spark) == expected
    write_snapshot(spark, place.history, MEASUREMENTS, second, first)
    compact_history(spark, place.history, MEASUREMENTS)
    send(spark, place.topics, message("b", 8.0, 30))
    place.run(spark)
    for snapshot in (first, second):
        rows = current_rows(spark, place.history, MEASUREMENTS, snapshot)
        assert sorted((r["id"], r["value"]) for r in rows.collect()) == [
            ("a", 2.0), ("b", 8.0), ("late", 7.0)]


def test_a_snapshot_older_than_a_generation_whose_epochs_are_gone(spark, place):
    snapshot = str(place.path / "snapshot")
    send(spark, place.topics, message("a", 1.0))
    place.run(spark)
    write_snapshot(spark, place.history, MEASUREMENTS, snapshot)
    for minute in (1, 2):
        send(spark, place.topics, message("b", float(minute), minute), "broken")
        place.run(spark)
        compact_history(spark, place.history, MEASUREMENTS, drop=True)
    assert len(open_log(spark, place.history).recorded) == 1
    rows = current_rows(spark, place.history, MEASUREMENTS, snapshot).collect()
    assert sorted((r["id"], r["value"]) for r in rows) == [("a", 1.0), ("b", 2.0)]
    assert read_stored(spark, place.history, MEASUREMENTS).count() == 5
    assert read_rejects(spark, place.history, MEASUREMENTS).count() == 2


def test_latest_rows_are_kept_in_buckets(spark, place):
    """Only the epochs since are moved; the history is not read, and its hot keys are one row each."""
    for minutes in ((0, 1, 2), (5, 9)):
        send(spark, place.topics, *[message(k, float(m), m) for m in minutes for k in "abc"], "broken")
        place.run(spark)
        compact_current(spark, place.history, MEASUREMENTS, drop=True)
    send(spark, place.topics, message("a", 1.5, 7), message("b", 11.0, 11), message("d", 4.0, 4))
    place.run(spark)
    rows = current_rows(spark, place.history, MEASUREMENTS)
    assert rows.columns == table_schema(MEASUREMENTS).names
    want = [("a", 9.0), ("b", 11.0), ("c", 9.0), ("d", 4.0)]
    assert sorted((r["id"], r["value"]) for r in rows.collect()) == place.latest(spark) == want
    text = plan(current_rows(spark, place.history, MEASUREMENTS))
    assert "SelectedBucketsCount: 4 out of 4" in text and "generation=1/rows" not in text
    # Between the kept rows and the join there is neither an exchange nor an aggregate; the epochs since have both.
    lines = text[:text.index("\n\n")].splitlines()
    [kept] = [n for n, line in enumerate(lines) if "gaugewright_clustered" in line]
    [since] = [n for n, line in enumerate(lines) if "Scan parquet" in line and n != kept]
    [join] = [n for n, line in enumerate(lines) if "Join" in line]
    assert join < kept < since
    assert not any(word in line for line in lines[join:kept] for word in ("Exchange", "Aggregate"))
    assert all(any(word in line for line in lines[kept:since]) for word in ("Exchange", "Aggregate"))
    # A reader that does not have the table yet declares it; one that drops it leaves the files.
    forget_clustered(spark, f"{open_log(spark, place.history).generation}/latest")
    assert sorted((r["id"], r["value"]) for r in current_rows(spark, place.history, MEASUREMENTS).collect()) == want


def test_readers_take_generations_and_only_finished_epochs(spark, place):
    send(spark, place.topics, message("a", 1.0), "broken")
    send(spark, place.topics, message("b", 2.0))
    place.run(spark)
    before = sorted(map(str, read_stored(spark, place.history, MEASUREMENTS).collect()))
    assert compact_history(spark, place.history, MEASUREMENTS)
    assert compact_history(spark, place.history, MEASUREMENTS) is None
    assert sorted(map(str, read_stored(spark, place.history, MEASUREMENTS).collect())) == before
    send(spark, place.topics, message("c", 3.0))
    place.run(spark)
    assert place.values(spark) == [1.0, 2.0, 3.0]
    log = open_log(spark, place.history)
    assert len(log.held) == 2 and len(log.added) == 1
    files = read_stored(spark, place.history, MEASUREMENTS).inputFiles()
    assert {f.split("epoch=")[1][0] for f in files if "run=" in f} == {"2"}
    # The last epoch, and a generation, without a record are not there yet.
    [(run, epoch)] = log.added
    delete_folder(spark, record_path(place.history, run, epoch))
    delete_folder(spark, f"{place.history}/_records/generation=0.json")
    assert place.values(spark) == [1.0, 2.0]


def test_a_folder_that_is_no_history_is_an_error(spark, place):
    send(spark, place.topics, message("a", 1.0))
    place.run(spark)
    target = str(place.path / "dates")
    rewrite_by_date(read_history(spark, place.history, MEASUREMENTS), target)
    with pytest.raises(ValueError, match="ingest_date"):
        read_history(spark, target, MEASUREMENTS)
    assert read_dated(spark, target, MEASUREMENTS).count() == 1
    with pytest.raises(FileNotFoundError):
        read_history(spark, str(place.path / "nothing"), MEASUREMENTS)


def test_a_batch_is_written_as_one_file_per_date(spark, tmp_path):
    texts = [(message(str(i), 1.0).replace("2024-01-01 00", f"2024-01-0{1 + i % 3} 00"),) for i in range(90)]
    messages = spark.createDataFrame(texts, "value string").repartition(8)
    HistorySink(str(tmp_path / "h"), MEASUREMENTS)(messages, "r", 0)
    assert len(list((tmp_path / "h").glob("**/part-*.parquet"))) == 3


def test_two_pass_reads_only_dates_of_latest_rows(spark, place):
    """``old`` was last seen on the first day, ``a`` on the third; the second is skipped."""
    days = [message(key, value).replace("2024-01-01 00", f"2024-01-0{day} 00")
            for key, value, day in (("old", 1.0, 1), ("a", 2.0, 1), ("a", 3.0, 2), ("a", 4.0, 3))]
    send(spark, place.topics, *days)
    place.run(spark)
    history = read_history(spark, place.history, MEASUREMENTS)
    view = latest_measurements(history, partial(latest_by_key_two_pass, date="ingest_date"))
    assert sorted((r["id"], r["value"]) for r in view.collect()) == [("a", 4.0), ("old", 1.0)]
    filters = view._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1]
    assert "IN (2024-01-01,2024-01-03)" in filters or "IN (2024-01-03,2024-01-01)" in filters


def test_two_pass_with_dates_of_no_rows(spark, place):
    send(spark, place.topics, "broken", '{"id":"a","value":1.0}')
    place.run(spark)
    history = read_history(spark, place.history, MEASUREMENTS)
    view = latest_measurements(history, partial(latest_by_key_two_pass, date="ingest_date"))
    assert view.count() == 0
