import json

import pytest
from pyspark.errors import StreamingQueryException

from gaugewright.jobs import _arguments, main
from gaugewright.plans.scales import StageScales
from gaugewright.sources import topics as topics_module
from gaugewright.sources.topics import FileTopics


def land(folder, name, document):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(json.dumps(document, indent=1))


def test_documents_to_status_by_jobs(spark, tmp_path):
    land(tmp_path / "stations", "1.json", {"items": [
        {"RLOIid": "s1", "label": "One", "status": "Active", "stageScale": "u1",
         "measures": [{"@id": "a"}]},
        {"RLOIid": "s2", "label": "Two", "status": "Active", "stageScale": "gone",
         "measures": [{"@id": "a"}]},
        {"RLOIid": "s3", "label": "Three", "stageScale": "u1", "measures": [{"@id": "a"}]}]})
    land(tmp_path / "scales", "1.json",
         {"url": "u1", "items": {"typicalRangeHigh": 1.0, "typicalRangeLow": 0.5}})
    land(tmp_path / "measurements", "1.json", {"items": [
        {"@id": "a", "latestReading": {"dateTime": "2024-07-01T12:00:00Z", "value": 0.4}}]})

    def run(*words):
        main([str(w) for w in words], spark)

    topics = f"file:{tmp_path}/topics"
    run("ingest", "stations", "--documents", tmp_path / "stations", "--stage-scales",
        tmp_path / "scales", "--topics", topics, "--checkpoint", tmp_path / "c1",
        "--match", "status=Active", "--available-now")
    run("ingest", "measurements", "--documents", tmp_path / "measurements", "--topics", topics,
        "--checkpoint", tmp_path / "c2", "--available-now")
    run("consume", "--topics", topics, "--checkpoint", tmp_path / "c3", "--history",
        tmp_path / "history", "--available-now")
    run("state", "--topics", topics, "--checkpoint", tmp_path / "c4", "--state",
        tmp_path / "state", "--available-now")
    run("snapshot", "--history", tmp_path / "history", "--output", tmp_path / "snapshot")
    run("consume", "--topics", topics, "--checkpoint", tmp_path / "c5", "--database", "jobs_levels",
        "--rejects", tmp_path / "rejects", "--available-now")
    run("views", "--database", "jobs_levels")
    assert spark.table("jobs_levels.stationsmeasurements").count() == 1
    run("compact", "--history", tmp_path / "history")
    run("refresh", "--history", tmp_path / "history", "--view", tmp_path / "view")
    run("metrics", "--history", tmp_path / "history", "--output", tmp_path / "metrics")
    run("compact", "--state", tmp_path / "state")
    for source in (["--history", tmp_path / "history"],
                   ["--history", tmp_path / "history", "--one-pass"],
                   ["--history", tmp_path / "history", "--snapshot", tmp_path / "snapshot"],
                   ["--state", tmp_path / "state"], ["--checkpoint", tmp_path / "c4"], ["--view", tmp_path / "view"], ["--database", "jobs_levels"]):
        run("status", *source, "--output", tmp_path / "out")
        [row] = spark.read.parquet(str(tmp_path / "out")).collect()
        assert row["station_name"] == "One" and row["color"] == [0, 51, 255]
        assert row["last_update"] == "2024-07-01 14:00"


def test_bad_documents_are_kept_on_request(spark, tmp_path):
    land(tmp_path / "measurements", "1.json", {"items": [
        {"@id": "a", "latestReading": {"dateTime": "2024-07-01T12:00:00Z", "value": 0.4}}]})
    (tmp_path / "measurements" / "2.json").write_text("<html>no service</html>")
    main(["ingest", "measurements", "--documents", f"{tmp_path}/measurements", "--topics",
          f"file:{tmp_path}/topics", "--checkpoint", f"{tmp_path}/c", "--available-now",
          "--keep-bad"], spark)
    topics = FileTopics(f"{tmp_path}/topics")
    assert topics.read(spark, "measurements").count() == 1
    [bad] = topics.read(spark, "measurements-rejects").collect()
    assert bad["value"] == "<html>no service</html>"


def test_items_fetch_times_keys_and_bounds(spark, tmp_path):
    folder = tmp_path / "items"
    folder.mkdir()
    for n in (1, 2, 3):
        item = {"@id": f"m{n}", "fetched": f"2024-01-0{n} 00:00:00",
                "latestReading": {"dateTime": "2024-07-01T12:00:00Z", "value": n}}
        (folder / f"{n}.json").write_text(json.dumps(item) + "\n" + ("" if n < 3 else "junk\n"))
    words = ["ingest", "measurements", "--documents", f"{folder}", "--items", "--topics",
             f"file:{tmp_path}/topics", "--checkpoint", f"{tmp_path}/c", "--available-now",
             "--fetched-at", "fetched", "--key", "id", "--max-files", "1", "--keep-bad"]
    main(words, spark)
    topics = FileTopics(f"{tmp_path}/topics")
    rows = sorted((r["key"], json.loads(r["value"])["last_update"][:10])
                  for r in topics.read(spark, "measurements").collect())
    assert rows == [("m1", "2024-01-01"), ("m2", "2024-01-02"), ("m3", "2024-01-03")]
    [bad] = topics.read(spark, "measurements-rejects").collect()
    assert (bad["key"], bad["value"]) == ("malformed item", "junk")
    # One batch per file, and a batch fails on a bad item unless it is to be kept.
    assert len(list((tmp_path / "c" / "offsets").glob("[0-9]*"))) == 3
    with pytest.raises(StreamingQueryException, match="junk"):
        main([*words[:-1], "--checkpoint", f"{tmp_path}/c2"], spark)


def test_stage_scales_arrive_between_batches(spark, tmp_path):
    def station(n):
        land(tmp_path / "stations", f"{n}.json", {"items": [
            {"RLOIid": f"s{n}", "stageScale": "u", "measures": [{"@id": "a"}]}], "at": f"2024-01-0{n} 00:00:00"})

    def scale(n, high, fetched):
        land(tmp_path / "scales", f"{n}.json",
             {"url": "u", "items": {"typicalRangeHigh": high, "typicalRangeLow": 0.0}, "at": fetched})

    words = ["ingest", "stations", "--documents", f"{tmp_path}/stations", "--stage-scales",
             f"{tmp_path}/scales", "--topics", f"file:{tmp_path}/topics", "--checkpoint", f"{tmp_path}/c",
             "--available-now", "--fetched-at", "at", "--scales-fetched-at", "at"]

    def highs():
        rows = FileTopics(f"{tmp_path}/topics").read(spark, "stations").collect()
        values = [json.loads(r["value"]) for r in rows]
        return {v["rloiid"]: v["typicalrangehigh"] for v in values}

    station(1)
    scale(1, 5.0, "2024-01-02 00:00:00")
    main(words, spark)
    station(2)
    scale(2, 9.0, "2024-01-01 00:00:00")  # copied later, but fetched earlier
    main(words, spark)
    station(3)
    scale(3, 7.0, "2024-01-03 00:00:00")
    main(words, spark)
    assert highs() == {"s1": 5.0, "s2": 5.0, "s3": 7.0}
    land(tmp_path / "stations", "4.json", {"items": [{"RLOIid": "s4", "stageScale": "gone", "measures": []}],
                                           "at": "2024-01-04 00:00:00"})
    with pytest.raises(StreamingQueryException, match="gone"):
        main([*words, "--strict"], spark)


def highs_of(rows):
    return sorted(r["high"] for r in rows.collect())


def test_only_new_scale_files_are_read_also_by_a_new_process(spark, tmp_path):
    def scales():
        return StageScales(spark, str(tmp_path / "scales"), str(tmp_path / "table"))

    land(tmp_path / "scales", "1.json", {"url": "u", "items": {"typicalRangeHigh": 1.0}})
    assert highs_of(scales().current()) == [1.0]
    (tmp_path / "scales" / "1.json").write_text("broken")
    assert highs_of(scales().current()) == [1.0] and scales().last()["number"] == 0
    for n in (2, 3, 4):
        land(tmp_path / "scales", f"{n}.json", {"url": f"u{n}", "items": {"typicalRangeHigh": float(n)}})
        assert highs_of(scales().current()) == [1.0, *map(float, range(2, n + 1))]
    assert len(list((tmp_path / "table").glob("version=*"))) == 2
    assert len(list((tmp_path / "table").glob("log/run=*/epoch=*"))) <= 3
    empty = StageScales(spark, str(tmp_path / "nothing"), str(tmp_path / "none"))
    assert empty.current().collect() == [] and empty.current("r", 0).collect() == []


def test_a_replayed_batch_is_joined_with_the_scales_it_saw(spark, tmp_path):
    def scales():
        return StageScales(spark, str(tmp_path / "scales"), str(tmp_path / "table"), fetched_at="at")

    def land_scale(n):
        land(tmp_path / "scales", f"{n}.json",
             {"url": "u", "items": {"typicalRangeHigh": float(n)}, "at": f"2024-01-0{n} 00:00:00"})

    land_scale(1)
    assert highs_of(scales().current("r", 0)) == [1.0]
    land_scale(2)
    assert highs_of(scales().current("r", 0)) == [1.0]
    assert highs_of(scales().current("r", 1)) == [2.0]
    land_scale(3)
    assert highs_of(scales().current("other", 0)) == [3.0]
    assert highs_of(scales().current("r", 1)) == [2.0]
    land_scale(4)
    assert highs_of(scales().current("r", 2)) == [4.0]


def test_a_crash_anywhere_in_ingest_leaves_no_message_twice(spark, tmp_path, monkeypatch):
    """Between the files and their record, between the record and the move, within the move, and before the commit."""
    for n in (1, 2):
        land(tmp_path / "stations", f"{n}.json", {"items": [
            {"RLOIid": f"s{n}", "stageScale": "u", "measures": [{"@id": "a"}]}, {"RLOIid": "bad", "stageScale": "u"}],
            "at": "2024-01-01 00:00:00"})
    land(tmp_path / "scales", "1.json",
         {"url": "u", "items": {"typicalRangeHigh": 1.0}, "at": "2024-01-01 00:00:00"})
    words = ["ingest", "stations", "--documents", f"{tmp_path}/stations", "--stage-scales", f"{tmp_path}/scales",
             "--topics", f"file:{tmp_path}/topics", "--checkpoint", f"{tmp_path}/c", "--available-now",
             "--fetched-at", "at", "--scales-fetched-at", "at"]
    topics = FileTopics(f"{tmp_path}/topics")

    def rows():
        names = [t for t in ("stations", "stations-rejects") if (tmp_path / "topics" / f"topic={t}").exists()]
        return sorted(json.loads(r["value"]).get("rloiid", "bad") for t in names for r in topics.read(spark, t).collect())

    def lost(*args):
        raise RuntimeError("lost")

    def lost_before_record(rows, path, run, epoch, partitions):
        rows.write.partitionBy(*partitions).parquet(f"{path}/run={run}/epoch={epoch}/attempt=dead")
        raise RuntimeError("lost")

    real_move, moved = topics_module.move_file, []

    def lost_after_one(*args):
        if moved:
            raise RuntimeError("lost")
        moved.append(real_move(*args))

    real_write = FileTopics.write_epoch

    def lost_after_all(*args):
        real_write(*args)
        raise RuntimeError("lost")

    for place, name, crash, seen in (
            (topics_module, "write_epoch", lost_before_record, 0), (topics_module, "move_file", lost, 0),
            (topics_module, "move_file", lost_after_one, 1), (FileTopics, "write_epoch", lost_after_all, 4)):
        monkeypatch.setattr(place, name, crash)
        with pytest.raises(StreamingQueryException, match="lost"):
            main(words, spark)
        monkeypatch.undo()
        assert len(rows()) == seen
        # A scale that comes before the replay does not change what it sends.
        land(tmp_path / "scales", f"{seen}-{name}.json",
             {"url": "u", "items": {"typicalRangeHigh": 9.0}, "at": "2024-01-09 00:00:00"})
    main(words, spark)
    assert rows() == ["bad", "bad", "s1", "s2"]
    assert {json.loads(r["value"])["typicalrangehigh"] for r in topics.read(spark, "stations").collect()} == {1.0}
    stream = topics.read_stream(spark, "stations").writeStream.format("memory").queryName("seen").option(
        "checkpointLocation", f"{tmp_path}/c3").trigger(availableNow=True).start()
    stream.awaitTermination()
    assert spark.table("seen").count() == 2


def test_sizes():
    words = ["ingest", "measurements", "--documents", "d", "--topics", "file:x", "--checkpoint", "c", "--max-bytes"]
    assert [_arguments([*words, size]).max_bytes for size in ("10g", "5K", "77")] == [10 << 30, 5 << 10, 77]
    assert _arguments(words[:-1]).max_bytes is None


WRONG = [
    "ingest measurements --documents d --topics file:x --checkpoint c --max-bytes 1.5g",
    "consume --topics nowhere --checkpoint c", "consume --topics file:x --checkpoint c",
    "ingest stations --documents d --topics file:x --checkpoint c", "sail",
    "consume --topics file:x --checkpoint c --jdbc-url u",
    "consume --topics file:x --checkpoint c --history h --rejects r",
    "consume --topics file:x --checkpoint c --history h --max-offsets 5",
    "consume --topics kafka:b:1 --checkpoint c --history h --max-files 5",
    "status --output o", "status --state s --snapshot x --output o", "status --state s --history h --output o",
    "status --database d --snapshot x --output o", "status --state s --one-pass --output o",
    "ingest measurements --documents d --topics file:x --checkpoint c --strict",
    "ingest measurements --documents d --topics file:x --checkpoint c --lines --items",
    "status --view v --one-pass --output o", "status --history h --jdbc-view x --output o",
    "status --jdbc-url u --jdbc-view x --jdbc-key-hash h --output o",
    "state --topics file:x --checkpoint c --compact-every 5", "compact --state s --keep", "compact", "metrics --history h",
]


@pytest.mark.parametrize("words", WRONG)
def test_wrong_arguments(spark, words):
    with pytest.raises(SystemExit):
        main(words.split(), spark)


def test_broker_options():
    args = _arguments("consume --topics kafka:b:9092 --checkpoint c --history h --max-offsets 500 "
                      "--min-partitions 64 --topic-option kafka.security.protocol=SASL_SSL".split())
    options = args.topics.options("stations")
    assert options["maxOffsetsPerTrigger"] == "500" and options["minPartitions"] == "64"
    assert options["kafka.security.protocol"] == "SASL_SSL"
