"""The joined view kept up to date by what changed."""

import json
import random
import shutil

import pytest

from gaugewright.plans.maintained import JoinedView
from gaugewright.plans.views import stations_measurements
from gaugewright.schemas import MEASUREMENTS, STATIONS
from gaugewright.sinks.history import HistorySink, compact_history
from gaugewright.sources import epochs
from gaugewright.sources.history import read_history
from tests.conftest import plan


def stamp(minute):
    return f"2024-01-01 {minute // 60:02d}:{minute % 60:02d}:00.000000"


def station(key, measure, minute=0):
    return json.dumps({"rloiid": key, "measures_id": measure, "label": f"at {minute}", "last_update": stamp(minute)})


def reading(key, value, minute=0):
    return json.dumps({"id": key, "value": value, "last_update": stamp(minute)})


class Place:
    def __init__(self, spark, path, **settings):
        self.spark, self.path = spark, path
        self.histories = {t: f"{path}/{t}" for t in (STATIONS, MEASUREMENTS)}
        self.view = JoinedView(spark, self.histories, f"{path}/view", **settings)
        self.epochs = {t: 0 for t in self.histories}

    def send(self, stations=(), measurements=()):
        for topic, texts in ((STATIONS, stations), (MEASUREMENTS, measurements)):
            rows = self.spark.createDataFrame([(t,) for t in texts], "value string")
            HistorySink(self.histories[topic], topic)(rows, "r", self.epochs[topic])
            self.epochs[topic] += 1

    def shown(self):
        return sorted((r["station_id"], r["station_name"], r["value"]) for r in self.view.read().collect())

    def whole(self):
        histories = [read_history(self.spark, self.histories[t], t) for t in (STATIONS, MEASUREMENTS)]
        return sorted((r["station_id"], r["station_name"], r["value"]) for r in stations_measurements(*histories).collect())


@pytest.fixture
def place(spark, tmp_path):
    return Place(spark, tmp_path, buckets=4)


def test_changes_on_either_side(place):
    place.send([station("s1", "a"), station("s2", "a"), station("s3", "b"), station("s4", None)], [reading("a", 1.0)])
    assert place.view.refresh() == 4
    assert place.shown() == place.whole() == [("s1", "at 0", 1.0), ("s2", "at 0", 1.0)]
    assert place.view.refresh() == 0
    # A measure that two stations share, and one that comes into being.
    place.send([], [reading("a", 2.0, 5)])
    assert place.view.refresh() == 2
    place.send([], [reading("b", 3.0, 5), reading("unused", 9.0)])
    assert place.view.refresh() == 1
    assert place.shown() == place.whole() == [("s1", "at 0", 2.0), ("s2", "at 0", 2.0), ("s3", "at 0", 3.0)]
    # A station that goes to another measure, and one that goes to none.
    place.send([station("s1", "b", 7), station("s2", "gone", 7)], [])
    assert place.view.refresh() == 2
    assert place.shown() == place.whole() == [("s1", "at 7", 3.0), ("s3", "at 0", 3.0)]
    # What it named before no longer changes its row's content.
    place.send([], [reading("a", 4.0, 9)])
    place.view.refresh()
    assert place.shown() == place.whole() == [("s1", "at 7", 3.0), ("s3", "at 0", 3.0)]


def test_late_and_repeated_rows_change_nothing(place):
    place.send([station("s1", "a", 9)], [reading("a", 1.0, 9)])
    place.view.refresh()
    place.send([station("s1", "b", 3), station("s1", "a", 9)], [reading("a", 5.0, 2), reading("a", 1.0, 9)])
    assert place.view.refresh() == 0
    assert place.shown() == place.whole() == [("s1", "at 9", 1.0)]


def test_random_histories_with_bases_between(spark, tmp_path):
    chance = random.Random(6)
    place = Place(spark, tmp_path, buckets=3, compact_every=2)
    for round_ in range(5):
        place.send(
            [station(f"s{chance.randrange(8)}", chance.choice(["a", "b", "c", "d", None]), chance.randrange(200)) for _ in range(6)],
            [reading(chance.choice("abcde"), float(chance.randrange(90)), chance.randrange(200)) for _ in range(4)])
        if round_ == 2:
            compact_history(spark, place.histories[STATIONS], STATIONS, drop=True)
        place.view.refresh()
        assert place.shown() == place.whole()
    assert any(f.startswith("base=") for folders in place.view.state()["parts"].values() for f in folders)
    assert len(list(tmp_path.glob("view/base=*"))) <= 2


def test_only_buckets_of_changed_keys_are_read(spark, tmp_path):
    """Files of all other buckets are gone: a refresh does not miss them."""
    place = Place(spark, tmp_path, buckets=16)
    place.send([station(f"s{i}", f"m{i}") for i in range(40)], [reading(f"m{i}", float(i)) for i in range(40)])
    place.view.refresh()
    before = place.view.state()
    keys = {"stations": ("rloiid", "s7"), "measurements": ("id", "m7"), "index": ("measures_id", "m7")}
    for part, (column, key) in keys.items():
        wanted = place.view._touched(spark.createDataFrame([(key,)], f"{column} string"), part, before)
        [folder] = before["parts"][part]
        for bucket in (tmp_path / "view" / folder).glob("bucket=*"):
            if int(bucket.name.partition("=")[2]) not in wanted:
                shutil.rmtree(bucket)
    place.send([], [reading("m7", 70.0, 5)])
    assert place.view.refresh() == 1
    assert ("s7", "at 0", 70.0) in place.shown() and len(place.shown()) == 40
    # And rows of these buckets that did not change meet no join but the semi join on the changed keys.
    state = place.view.state()
    affected = spark.createDataFrame([("s7",)], "rloiid string")
    text = plan(place.view._of_keys(state, STATIONS, affected))
    assert "PartitionFilters: [isnotnull(bucket" in text.replace("PartitionFilters: [bucket", "PartitionFilters: [isnotnull(bucket")
    assert "LeftSemi" in text and "CartesianProduct" not in text


def test_a_refresh_that_dies_leaves_nothing_that_is_read(place, monkeypatch):
    place.send([station("s1", "a")], [reading("a", 1.0)])
    place.view.refresh()
    place.send([], [reading("a", 2.0, 5)])

    def lost(*args):
        raise RuntimeError("lost before the record")

    monkeypatch.setattr("gaugewright.plans.maintained.publish", lost)
    with pytest.raises(RuntimeError, match="lost"):
        place.view.refresh()
    monkeypatch.undo()
    assert place.shown() == [("s1", "at 0", 1.0)]
    assert place.view.refresh() == 1 and place.shown() == place.whole() == [("s1", "at 0", 2.0)]


def test_of_two_refreshes_one_fails(place, monkeypatch):
    place.send([station("s1", "a")], [reading("a", 1.0)])
    real = epochs.publish

    def beaten(spark, path, content):
        real(spark, path, {"other": True})
        return real(spark, path, content)

    monkeypatch.setattr("gaugewright.plans.maintained.publish", beaten)
    with pytest.raises(RuntimeError, match="came first"):
        place.view.refresh()


def test_an_empty_view(place):
    place.send()
    assert place.view.read().collect() == []
    assert place.view.refresh() == 0 and place.shown() == []
