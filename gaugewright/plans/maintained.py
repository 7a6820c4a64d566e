"""The joined view kept up to date: a refresh joins only what changed on either side since the one before.

    path/refresh=<n>/attempt=<id>/<part>/bucket=<b>/...   rows that a refresh changed
    path/base=<n>/attempt=<id>/<part>/bucket=<b>/...      all rows at one time, in place of the refreshes before
    path/_records/state=<n>.json                          the folders that make up the view, the epochs they come from

Parts are the current ``stations`` (by station) and ``measurements`` (by measure), the ``index`` from a measure to the stations that
name or once named it (by measure), and the ``joined`` rows (by station). Each is split into buckets by its key's hash, and a
refresh reads only the buckets of keys that changed. It takes the epochs of both histories that it has not seen,

1. finds the keys whose latest row they change, however late those rows came,
2. adds to the stations among them those that the index names for a changed measure,
3. joins these stations, no others, to their measures' current rows, and notes those that have none.

The record of a state is published last and once, so a refresh that dies leaves nothing that is read, and of two at the same
time one fails.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from gaugewright.operators.joins import same_key
from gaugewright.operators.latest import latest_by_key
from gaugewright.plans.views import JOINED_COLUMNS
from gaugewright.schemas import MEASUREMENTS, STATIONS, TOPIC_KEYS, table_schema
from gaugewright.session import shared_folder
from gaugewright.sources.epochs import RECORDS, delete_folder, exists, file_names, files_below, open_log, publish, read_json
from gaugewright.sources.history import read_history
from gaugewright.sources.ranges import Epochs

ORDER = ["sequence", "pk_id"]
BUCKETS = 64
# Refreshes between two bases.
COMPACT_EVERY = 20
INDEX, JOINED = "index", "joined"
KEYS = {STATIONS: "rloiid", MEASUREMENTS: "id", INDEX: "measures_id", JOINED: "rloiid"}


def _schema(part):
    if part == INDEX:
        return "measures_id STRING, rloiid STRING, bucket INT"
    if part == JOINED:
        columns = {f"s.{f.name}": f for f in table_schema(STATIONS).fields}
        columns.update({f"m.{f.name}": f for f in table_schema(MEASUREMENTS).fields})
        shown = ", ".join(f"{name} {columns[source].dataType.simpleString()}" for name, source in JOINED_COLUMNS.items())
        return f"rloiid STRING, found BOOLEAN, refresh BIGINT, {shown}, bucket INT"
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table_schema(part).fields) + ", bucket INT"


class JoinedView:
    """The view in the folder ``path`` over the histories {topic: folder}."""

    def __init__(self, spark, histories, path, buckets=BUCKETS, compact_every=COMPACT_EVERY):
        self.spark, self.histories, self.path = spark, histories, path
        self.buckets, self.compact_every = buckets, compact_every

    # State -----------------------------------------------------------------------------

    def state(self):
        """The last published state; an empty one to begin with."""
        folder = f"{self.path}/{RECORDS}"
        numbers = [int(n[len("state="):-len(".json")]) for n in file_names(self.spark, folder) if n.startswith("state=")]
        if not numbers:
            return {"number": -1, "buckets": self.buckets, "seen": {}, "since": 0, "parts": {}, "old": []}
        return read_json(self.spark, f"{folder}/state={max(numbers)}.json")

    def _publish(self, state):
        if not publish(self.spark, f"{self.path}/{RECORDS}/state={state['number']}.json", state):
            raise RuntimeError(f"another refresh of {self.path} came first")

    def rows(self, state, part, buckets=None):
        """Rows of a part, changed ones beside those they replace; of some ``buckets`` only."""
        folders = state["parts"].get(part, [])
        if not folders:
            return self.spark.createDataFrame([], _schema(part))
        found = [self.spark.read.schema(_schema(part)).parquet(f"{self.path}/{folder}") for folder in folders]
        if buckets is not None:
            found = [rows.where(F.col("bucket").isin(buckets)) for rows in found]
        out = found[0]
        for rows in found[1:]:
            out = out.unionByName(rows)
        return out

    def _with_bucket(self, rows, part, state):
        return rows.withColumn("bucket", F.pmod(F.xxhash64(KEYS[part]), F.lit(state["buckets"])).cast("int"))

    def _touched(self, keys, part, state):
        """The buckets of some keys: as many as there are, at most."""
        rows = self._with_bucket(keys, part, state).select("bucket").distinct().collect()
        return sorted(r["bucket"] for r in rows)

    def _of_keys(self, state, part, keys):
        """A part's rows of the ``keys`` (one column, of the part's key): from their buckets alone."""
        rows = self.rows(state, part, self._touched(keys, part, state))
        wanted = keys.select(F.col(KEYS[part]).alias("wanted")).distinct()
        return rows.join(wanted, same_key(F.col(KEYS[part]), F.col("wanted")), "left_semi")

    # Refresh ---------------------------------------------------------------------------

    def refresh(self):
        """Take in the new epochs of both histories; returns the number of joined rows that were made anew."""
        shared_folder(self.spark)
        before = self.state()
        logs = {topic: open_log(self.spark, folder) for topic, folder in self.histories.items()}
        seen = {topic: Epochs.from_json(before["seen"].get(topic, {})) for topic in logs}
        if not any(log.epochs - seen[topic] for topic, log in logs.items()):
            return 0
        state = {**before, "number": before["number"] + 1, "since": before["since"] + 1, "parts": dict(before["parts"])}
        folder = f"refresh={state['number']}/attempt={uuid.uuid4().hex}"
        for topic, log in logs.items():
            self._store(state, folder, topic, self._changed(before, topic, log, seen[topic]))
            state["seen"] = {**state["seen"], topic: (seen[topic] | log.epochs).to_json()}
        new = {part: self._delta(state, folder, part) for part in (STATIONS, MEASUREMENTS)}
        self._store(state, folder, INDEX, new[STATIONS].where("measures_id IS NOT NULL").select("measures_id", "rloiid"))
        affected = self._affected(state, new)
        self._store(state, folder, JOINED, self._joined(state, affected))
        made = self._delta(state, folder, JOINED).count()
        self._publish(state)
        if state["since"] >= self.compact_every:
            self.compact()
        return made

    def _store(self, state, folder, part, rows):
        place = f"{folder}/{part}"
        self._with_bucket(rows, part, state).write.mode("errorifexists").partitionBy("bucket").parquet(f"{self.path}/{place}")
        if files_below(self.spark, f"{self.path}/{place}"):
            state["parts"][part] = [*state["parts"].get(part, []), place]

    def _delta(self, state, folder, part):
        """What this refresh has stored of a part."""
        place = f"{folder}/{part}"
        return self.rows({"parts": {part: [p for p in state["parts"].get(part, []) if p == place]}}, part)

    def _changed(self, state, topic, log, seen):
        """Rows that are now the latest of their key and were not before."""
        columns = table_schema(topic).names
        key = TOPIC_KEYS[topic]
        rows = read_history(self.spark, self.histories[topic], topic, log=log, without=seen)
        fresh = latest_by_key(rows, key, "last_update", ORDER, columns).checkpoint()
        known = self._of_keys(state, topic, fresh.select(key)).select(*columns, F.lit(1).alias("known"))
        both = fresh.withColumn("known", F.lit(0)).unionByName(known)
        return latest_by_key(both, key, "last_update", [*ORDER, "known"], [*columns, "known"]).where("known = 0").select(*columns)

    def _affected(self, state, new):
        """The stations whose joined row may differ: changed ones, and those of changed measures."""
        measures = new[MEASUREMENTS].select(F.col("id").alias("measures_id"))
        named = self._of_keys(state, INDEX, measures).select("rloiid")
        return new[STATIONS].select("rloiid").unionByName(named).distinct().checkpoint()

    def _joined(self, state, affected):
        """Joined rows of the affected stations; ``found`` says whether their measure has a row."""
        s_names, m_names = table_schema(STATIONS).names, table_schema(MEASUREMENTS).names
        stations = latest_by_key(self._of_keys(state, STATIONS, affected), "rloiid", "last_update", ORDER, s_names).checkpoint()
        measures = stations.where("measures_id IS NOT NULL").select(F.col("measures_id").alias("id"))
        measurements = latest_by_key(self._of_keys(state, MEASUREMENTS, measures), "id", "last_update", ORDER, m_names)
        s, m = stations.alias("s"), measurements.alias("m")
        return s.join(m, same_key(F.col("s.measures_id"), F.col("m.id")), "left").select(
            "s.rloiid", F.col("m.id").isNotNull().alias("found"), F.lit(state["number"]).cast("bigint").alias("refresh"),
            *[F.col(column).alias(name) for name, column in JOINED_COLUMNS.items()])

    # Reading ---------------------------------------------------------------------------

    def _current(self, state, part):
        """One row per key. What no refresh since the base has touched is neither sorted nor moved."""
        schema = [f.name for f in self.rows(state, part).schema.fields]
        order = ("refresh", []) if part == JOINED else ("last_update", ORDER)
        base = [f for f in state["parts"].get(part, []) if f.startswith("base=")]
        changed = [f for f in state["parts"].get(part, []) if not f.startswith("base=")]
        rows = {name: self.rows({"parts": {part: folders}}, part) for name, folders in (("base", base), ("new", changed))}
        if part == INDEX:
            return rows["base"].unionByName(rows["new"]).distinct()
        new = latest_by_key(rows["new"], KEYS[part], *order, schema)
        gone = new.select(F.col(KEYS[part]).alias("gone"))
        return rows["base"].join(gone, same_key(F.col(KEYS[part]), F.col("gone")), "left_anti").unionByName(new)

    def read(self):
        """The joined view as of the last refresh."""
        return self._current(self.state(), JOINED).where("found").select(*JOINED_COLUMNS)

    def compact(self):
        """Write all current rows as a new base. Folders that the state before the last base used go."""
        before = self.state()
        state = {**before, "number": before["number"] + 1, "since": 0, "parts": {}}
        folder = f"base={state['number']}/attempt={uuid.uuid4().hex}"
        for part in KEYS:
            rows = self._current(before, part)
            if part == INDEX:  # only what stations name now
                now = self._current(before, STATIONS).select(F.col("rloiid").alias("s"), F.col("measures_id").alias("m"))
                rows = rows.join(now, (F.col("measures_id") == F.col("m")) & (F.col("rloiid") == F.col("s")), "left_semi")
            self._store(state, folder, part, rows.drop("bucket").hint("rebalance"))
        # A reader that began before may still be at the folders just replaced; older ones go.
        state["old"] = sorted({f.split("/")[0] for folders in before["parts"].values() for f in folders})
        self._publish(state)
        for name in before["old"]:
            if exists(self.spark, f"{self.path}/{name}"):
                delete_folder(self.spark, f"{self.path}/{name}")
