"""Records of epochs: what readers follow, and what they make of a log that lacks some."""

import json
import logging
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gaugewright.schemas import MEASUREMENTS
from gaugewright.sinks.history import HistorySink, RejectSink, compact_history
from gaugewright.sources import epochs
from gaugewright.sources.epochs import (
    adopt_epochs, delete_folder, open_log, publish, read_json, read_metrics, record_path, write_epoch,
)
from gaugewright.sources.history import read_history, read_rejects, read_stored
from gaugewright.sources.ranges import Epochs
from tests.test_streaming import message, place, send  # noqa: F401


def batch(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def stored(spark, path, *batches, run="r"):
    sink = HistorySink(str(path), MEASUREMENTS)
    for epoch, texts in enumerate(batches):
        sink(batch(spark, *texts), run, epoch)
    return str(path)


def values(spark, path):
    return sorted(r["value"] for r in read_history(spark, path, MEASUREMENTS).collect())


@pytest.fixture
def no_marker(spark):
    configuration = spark._jsc.hadoopConfiguration()
    configuration.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    yield
    configuration.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_all_rows_are_read_where_jobs_leave_no_marker(spark, place, no_marker):  # noqa: F811
    send(spark, place.topics, message("a", 1.0), "broken")
    send(spark, place.topics, message("b", 2.0, 1))
    place.run(spark)
    assert not list(place.path.glob("history/**/_SUCCESS"))
    assert place.values(spark) == [1.0, 2.0]
    assert read_rejects(spark, place.history, MEASUREMENTS).count() == 1
    assert compact_history(spark, place.history, MEASUREMENTS)
    send(spark, place.topics, message("c", 3.0, 2))
    place.run(spark)
    assert place.values(spark) == [1.0, 2.0, 3.0]


def test_an_attempt_that_failed_is_never_read(spark, place, monkeypatch):  # noqa: F811
    """The first attempt dies after its files, before its record; the replay's files alone count."""
    send(spark, place.topics, message("a", 1.0), message("b", 2.0))

    def lost(*args):
        raise RuntimeError("lost before the record")

    monkeypatch.setattr(epochs, "publish", lost)
    with pytest.raises(StreamingQueryException, match="lost before the record"):
        place.run(spark)
    monkeypatch.undo()
    assert len(list(place.path.glob("history/**/attempt=*"))) == 1
    assert place.values(spark) == []
    place.run(spark)
    assert len(list(place.path.glob("history/**/attempt=*"))) == 2
    assert place.values(spark) == [1.0, 2.0]


def test_a_recorded_epoch_is_not_written_again(spark, tmp_path):
    path = stored(spark, tmp_path / "h", [message("a", 1.0)])
    HistorySink(path, MEASUREMENTS)(batch(spark, message("z", 9.0)), "r", 0)
    assert values(spark, path) == [1.0]
    assert len(list(tmp_path.glob("h/run=r/epoch=0/attempt=*"))) == 1


def test_only_named_files_are_read(spark, tmp_path):
    path = stored(spark, tmp_path / "h", [message("a", 1.0)])
    [attempt] = tmp_path.glob("h/run=r/epoch=0/attempt=*/kind=accepted/*/*.parquet")
    (attempt.parent / "part-stray.parquet").write_bytes(attempt.read_bytes())
    assert values(spark, path) == [1.0]


def test_an_unrecorded_epoch_is_named(spark, tmp_path, caplog):
    path = stored(spark, tmp_path / "h", *[[message("a", float(i), i)] for i in range(3)])
    delete_folder(spark, record_path(path, "r", 2))
    with caplog.at_level(logging.WARNING, logger="gaugewright"):
        assert values(spark, path) == [0.0, 1.0]
    assert "epoch 2 of run r has no record yet" in caplog.text
    # One that a later epoch follows is no batch in the making.
    delete_folder(spark, record_path(path, "r", 0))
    with pytest.raises(ValueError, match=r"\('r', 0\)"):
        read_history(spark, path, MEASUREMENTS)


def test_epochs_from_before_the_records_are_an_error_until_adopted(spark, tmp_path):
    path = str(tmp_path / "h")
    rows = read_stored(
        spark, stored(spark, tmp_path / "new", [message("a", 1.0, 1), "broken"], [message("b", 2.0, 5)]), MEASUREMENTS)
    for epoch in (0, 1):
        rows.where(F.col("epoch") == epoch).drop("run", "epoch").write.partitionBy("kind", "ingest_date").parquet(
            f"{path}/run=old/epoch={epoch}")
    with pytest.raises(ValueError, match="adopt_epochs"):
        read_history(spark, path, MEASUREMENTS)
    assert adopt_epochs(spark, path) == [("old", 0), ("old", 1)] and adopt_epochs(spark, path) == []
    assert values(spark, path) == [1.0, 2.0]
    found = {r["epoch"]: (r["accepted"], r["rejected"]) for r in read_metrics(spark, path).collect()}
    assert found == {0: (1, 1), 1: (1, 0)}


def test_metrics_of_every_batch(spark, tmp_path):
    path = stored(spark, tmp_path / "h", [message("a", 1.0, 3), message("b", 1.0, 1), "x", "{}"], ["broken"], [])
    want = {
        0: (MEASUREMENTS, "r", 2, 2, "2024-01-01 00:01:00", "2024-01-01 00:03:00"),
        1: (MEASUREMENTS, "r", 0, 1, "None", "None"),
        2: (MEASUREMENTS, "r", 0, 0, "None", "None"),
    }

    def found():
        rows = read_metrics(spark, path).collect()
        assert len(rows) == len({r["epoch"] for r in rows}) and all(r["written_at"] for r in rows)
        return {r["epoch"]: (r["topic"], r["run"], r["accepted"], r["rejected"], str(r["first_stamp"]),
                             str(r["last_stamp"])) for r in rows}

    assert found() == want
    # They outlive compactions, and the epochs that these drop.
    for minute in (7, 8, 9):
        HistorySink(path, MEASUREMENTS)(batch(spark, message("c", 1.0, minute)), "r", minute)
        want[minute] = (MEASUREMENTS, "r", 1, 0, *[f"2024-01-01 00:0{minute}:00"] * 2)
        compact_history(spark, path, MEASUREMENTS, drop=True)
        assert found() == want
    assert len(open_log(spark, path).recorded) == 1


def test_reject_sinks_count_both_kinds(spark, tmp_path):
    RejectSink(str(tmp_path / "r"), MEASUREMENTS)(batch(spark, message("a", 1.0), "x", "y"), "r", 0)
    [row] = read_metrics(spark, str(tmp_path / "r")).collect()
    assert (row["accepted"], row["rejected"]) == (1, 2)
    assert read_rejects(spark, str(tmp_path / "r"), MEASUREMENTS).count() == 2


def test_many_open_epochs(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(epochs, "FEW_RECORDS", 2)
    path = stored(spark, tmp_path / "h", *[[message("a", float(i), i)] for i in range(5)])
    assert values(spark, path) == [0.0, 1.0, 2.0, 3.0, 4.0]


def test_the_first_record_stands(spark, tmp_path):
    path = f"{tmp_path}/x/y.json"
    assert publish(spark, path, {"n": 1}) and not publish(spark, path, {"n": 2})
    assert read_json(spark, path) == {"n": 1} and [p.name for p in (tmp_path / "x").glob("y*")] == ["y.json"]


def test_a_part_of_a_generation_is_read_from_what_is_left(spark, tmp_path):
    path = stored(spark, tmp_path / "h", *[[message("a", float(i), i)] for i in range(4)])
    compact_history(spark, path, MEASUREMENTS)
    for epoch in (0, 1):
        delete_folder(spark, f"{path}/run=r/epoch={epoch}")
        delete_folder(spark, record_path(path, "r", epoch))
    for without, want in ((Epochs(), [0, 1, 2, 3]), (Epochs({"r": [(0, 0)]}), [1, 2, 3]), (Epochs({"r": [(0, 1)]}), [2, 3]),
                          (Epochs({"r": [(1, 3)]}), [0]), (Epochs({"r": [(0, 9)]}), [])):
        rows = read_history(spark, path, MEASUREMENTS, without=without).collect()
        assert sorted(r["value"] for r in rows) == want


def test_ranges_are_sets():
    chance = random.Random(4)
    for _ in range(200):
        a, b = ({(chance.choice("xy"), chance.randrange(12)) for _ in range(chance.randrange(10))} for _ in "ab")
        left, right = Epochs.of(a), Epochs.of(b)
        everything = {(r, e) for r in "xyz" for e in range(-1, 13)}
        for made, want in ((left | right, a | b), (left - right, a - b)):
            assert {p for p in everything if p in made} == want and len(made) == len(want) and bool(made) == bool(want)
        assert left.meets(right) == bool(a & b)
        again = Epochs.from_json(json.loads(json.dumps(left.to_json())))
        assert again == left and hash(again) == hash(left)
        assert left.last("x") == max((e for r, e in a if r == "x"), default=-1)


def test_write_epoch_without_kinds(spark, tmp_path):
    write_epoch(spark.range(5), str(tmp_path / "s"), "r", 0, topic="t")
    [row] = read_metrics(spark, str(tmp_path / "s")).collect()
    assert (row["topic"], row["accepted"], row["rejected"], row["first_stamp"]) == ("t", 5, 0, None)
