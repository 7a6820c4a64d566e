"""Logs of finished batches: one folder per attempt at an epoch, a record for each, and compacted generations of them.

    path/run=<query>/epoch=<n>/attempt=<id>/...      rows of one attempt at a batch
    path/_records/run=<query>/epoch=<n>.json         says that the batch is stored: attempt, files, counts
    path/generation=<n>/rows/...                     the rows of many epochs
    path/generation=<n>/records/                     their records, without the files
    path/generation=<n>/latest/                      the latest row per key of a history, in buckets by key
    path/_records/generation=<n>.json                which epochs, as ranges; makes the generation whole

A record is renamed into place when all files of its attempt are there, so it is whole or absent, and the first one
counts. Readers follow records alone: they take the last generation and the recorded epochs that are not in it, and of these
the named files, whatever else lies in the folders. No marker of Hadoop's committers is needed. An epoch without a
record is named: in the log's warnings where it may still be in the making (the last of its run), else in an error.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Observation, functions as F

from gaugewright.sources.clustered import forget_clustered, read_clustered, write_clustered
from gaugewright.sources.ranges import Epochs

log = logging.getLogger("gaugewright.epochs")

RECORDS = "_records"
# A batch's metrics row, as its record holds it. Stamps are microseconds.
METRICS = ("topic STRING, run STRING, epoch BIGINT, attempt STRING, accepted BIGINT, rejected BIGINT, "
           "first_stamp BIGINT, last_stamp BIGINT, written_at BIGINT")
# So many records are read one by one; more of them in a Spark job.
FEW_RECORDS = 32


def _file_system(spark, path):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _names(spark, path, folders):
    files, target = _file_system(spark, path)
    if not files.exists(target):
        return []
    return [s.getPath().getName() for s in files.listStatus(target) if s.isDirectory() == folders]


def folder_names(spark, path):
    """Names of the folders in ``path``; none where it does not exist."""
    return _names(spark, path, True)


def file_names(spark, path):
    """Names of the files in ``path``; none where it does not exist."""
    return _names(spark, path, False)


def files_below(spark, path):
    """{file: (size, modification time)} of all files in a folder; none where it does not exist."""
    files, target = _file_system(spark, path)
    found = {}
    if files.exists(target):
        listing = files.listFiles(target, True)
        while listing.hasNext():
            status = listing.next()
            name = status.getPath().getName()
            if not name.startswith(("_", ".")):
                found[status.getPath().toString()] = (status.getLen(), status.getModificationTime())
    return found


def exists(spark, path):
    files, target = _file_system(spark, path)
    return files.exists(target)


def delete_folder(spark, path):
    files, target = _file_system(spark, path)
    files.delete(target, True)


def move_file(spark, source, target):
    """Rename a file; nothing to do if that was done before."""
    files, old = _file_system(spark, source)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    if files.exists(old):
        files.mkdirs(new.getParent())
        if not files.rename(old, new) and not files.exists(new):
            raise OSError(f"could not move {source} to {target}")
    elif not files.exists(new):
        raise FileNotFoundError(f"neither {source} nor {target} is there")


# Records -----------------------------------------------------------------------------------

def publish(spark, path, content):
    """Write a JSON file under a name of its own and rename it: readers see it whole or not at all.

    Returns whether this call's file is the one that stands; an earlier one is left as it is.
    """
    if exists(spark, path):
        return False
    folder, _, name = path.rpartition("/")
    files, draft = _file_system(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    files.mkdirs(draft.getParent())
    out = files.create(draft, False)
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if files.rename(draft, target):
        return True
    files.delete(draft, False)
    if not files.exists(target):
        raise OSError(f"could not publish {path}")
    return False


def read_json(spark, path):
    files, target = _file_system(spark, path)
    source = files.open(target)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    finally:
        source.close()


def record_path(path, run, epoch):
    return f"{path}/{RECORDS}/run={run}/epoch={epoch}.json"


def is_recorded(spark, path, run, epoch):
    return exists(spark, record_path(path, run, epoch))


def _read_records(spark, path, pairs):
    places = [record_path(path, *pair) for pair in sorted(pairs)]
    if len(places) <= FEW_RECORDS:
        return [read_json(spark, place) for place in places]
    rows = spark.read.text(places, wholetext=True).collect()
    return [json.loads(row["value"]) for row in rows]


# Writing -----------------------------------------------------------------------------------

def measured(rows):
    """``rows``, and the observation that counts them by kind as they pass, with their first and last stamp.

    Put it into the stage that writes: there every row counts once, also if an executor is lost.
    """
    seen = Observation()
    kept = (F.col("kind") == "accepted") if "kind" in rows.columns else F.lit(True)
    stamp = F.unix_micros("last_update") if "last_update" in rows.columns else F.lit(None).cast("bigint")
    stamp = F.when(kept, stamp)
    return rows.observe(
        seen, F.count(F.when(kept, 1)).alias("accepted"), F.count(F.when(~kept, 1)).alias("rejected"),
        F.min(stamp).alias("first_stamp"), F.max(stamp).alias("last_stamp")), seen


def write_epoch(rows, path, run, epoch, partitions=(), topic=None, seen=None):
    """Write a batch to a folder of its attempt, then record it. An epoch that is recorded is not written again.

    The run is the query's id, which outlives restarts on one checkpoint. Epochs alone start at 0 again with a new
    checkpoint. What an attempt without a record left behind is never read, and goes with the epoch.
    """
    spark = rows.sparkSession
    if is_recorded(spark, path, run, epoch):
        return
    attempt = uuid.uuid4().hex
    if seen is None:
        rows, seen = measured(rows)
    folder = f"{path}/run={run}/epoch={epoch}/attempt={attempt}"
    rows.write.mode("errorifexists").partitionBy(*partitions).parquet(folder)
    _record(spark, path, run, epoch, attempt, folder, topic, seen.get)


def _record(spark, path, run, epoch, attempt, folder, topic, counts):
    files, base = _file_system(spark, path)
    skipped = len(files.makeQualified(base).toString()) + 1
    names = [[name[skipped:], size] for name, (size, _) in sorted(files_below(spark, folder).items())]
    publish(spark, record_path(path, run, epoch), {
        "topic": topic, "run": run, "epoch": epoch, "attempt": attempt, **dict(counts),
        "written_at": time.time_ns() // 1000, "files": names})


def adopt_epochs(spark, path):
    """Record epochs that were written before there were records, if Hadoop marked them as finished.

    Their counts are read from their files. Returns the adopted (run, epoch) pairs.
    """
    adopted = []
    for run, epoch in sorted(_unrecorded(spark, path)):
        folder = f"{path}/run={run}/epoch={epoch}"
        if not exists(spark, f"{folder}/_SUCCESS"):
            continue
        rows, seen = measured(spark.read.parquet(folder))
        rows.write.format("noop").mode("overwrite").save()
        _record(spark, path, run, epoch, None, folder, None, seen.get)
        adopted.append((run, epoch))
    return adopted


# Reading -----------------------------------------------------------------------------------

@dataclass(frozen=True)
class Log:
    """What there was to read at one moment. ``held`` are the generation's epochs, ``added`` the recorded ones beside
    it with their records, ``recorded`` all epochs whose own files are still there."""

    path: str
    generation: str | None
    held: Epochs = Epochs()
    added: dict = field(default_factory=dict, repr=False)
    recorded: frozenset = field(default=frozenset(), repr=False)

    @property
    def epochs(self):
        return self.held | Epochs.of(self.added)


def read_epochs(spark, path):
    """The epochs that a snapshot was made of."""
    return Epochs.from_json(read_json(spark, f"{path}/epochs.json"))


def write_epochs(spark, epochs, path):
    publish(spark, f"{path}/epochs.json", epochs.to_json())


def generations(spark, path):
    """Numbers of the whole generations, in order."""
    names = file_names(spark, f"{path}/{RECORDS}")
    return sorted(int(n[len("generation="):-len(".json")]) for n in names if n.startswith("generation="))


def _generation_record(path, number):
    return f"{path}/{RECORDS}/generation={number}.json"


def _held(spark, path, number):
    return Epochs.from_json(read_json(spark, _generation_record(path, number))["epochs"])


def _recorded(spark, path):
    """All (run, epoch) pairs with a record."""
    found = set()
    for run in (n.partition("=")[2] for n in folder_names(spark, f"{path}/{RECORDS}") if n.startswith("run=")):
        for name in file_names(spark, f"{path}/{RECORDS}/run={run}"):
            if name.startswith("epoch="):
                found.add((run, int(name[len("epoch="):-len(".json")])))
    return found


def _unrecorded(spark, path, known=None):
    """(run, epoch) pairs that have a folder and are neither recorded nor held."""
    if known is None:
        whole = generations(spark, path)
        known = Epochs.of(_recorded(spark, path)) | (_held(spark, path, whole[-1]) if whole else Epochs())
    found = set()
    for run in (n.partition("=")[2] for n in folder_names(spark, path) if n.startswith("run=")):
        for name in folder_names(spark, f"{path}/run={run}"):
            if name.startswith("epoch="):
                pair = (run, int(name.partition("=")[2]))
                if pair not in known:
                    found.add(pair)
    return found


def _name_unrecorded(path, pairs, known):
    """Of a run, the last epoch may be in the making; any other without a record is an error."""
    last = {}
    for run, epoch in pairs:
        last[run] = max(epoch, last.get(run, -1))
    lost = sorted(p for p in pairs if p[1] < max(last[p[0]], known.last(p[0])))
    if lost:
        raise ValueError(
            f"{path} holds {len(lost)} epochs without a record, such as {lost[:3]}: they were written before there were "
            "records (see adopt_epochs), or their records are lost")
    for run, epoch in sorted(pairs):
        log.warning("%s: epoch %s of run %s has no record yet and is not read", path, epoch, run)


def open_log(spark, path):
    """The log's present state. A folder that is missing, or holds something else, is an error."""
    if not exists(spark, path):
        raise FileNotFoundError(f"there is no log of epochs at {path}")
    names = [n for n in folder_names(spark, path) if not n.startswith(("_", "."))]
    odd = [n for n in names if not n.startswith(("run=", "generation="))]
    if odd:
        raise ValueError(f"{path} is not a log of epochs: it holds {sorted(odd)[:3]}")
    whole = generations(spark, path)
    generation = f"{path}/generation={whole[-1]}" if whole else None
    held = _held(spark, path, whole[-1]) if whole else Epochs()
    # Folders first: an epoch that is recorded between the two listings is then not taken for one without a record.
    lying = _unrecorded(spark, path, held)
    recorded = _recorded(spark, path)
    known = held | Epochs.of(recorded)
    _name_unrecorded(path, {p for p in lying if p not in known}, known)
    records = _read_records(spark, path, [p for p in recorded if p not in held])
    added = {(r["run"], r["epoch"]): r for r in records}
    return Log(path, generation, held, added, frozenset(recorded))


def _rows_of(spark, path, records, schema):
    files = [f"{path}/{name}" for record in records for name, _ in record["files"]]
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*files)


def read_log(spark, log, schema, without=Epochs()):
    """Rows of the log, with its ``run`` and ``epoch`` if the schema names them, of all epochs that are not in
    ``without``. Epochs of the generation are read from their own files where these are still there and only some are wanted."""
    records = [r for pair, r in sorted(log.added.items()) if pair not in without]
    parts = []
    if log.generation:
        rows = spark.read.schema(schema).parquet(f"{log.generation}/rows")
        if not without.meets(log.held):
            parts.append(rows)
        elif rest := log.held - without:
            own = {p for p in log.recorded if p in rest}
            records += _read_records(spark, log.path, own)
            if missing := rest - Epochs.of(own):
                parts.append(rows.where(missing.condition(F.col("run"), F.col("epoch"))))
    if records or not parts:
        parts.append(_rows_of(spark, log.path, records, schema))
    # The folders' names come as columns, wanted or not.
    parts = [part.select(*schema.names) for part in parts]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def read_metrics(spark, path):
    """One row per recorded epoch, however old: topic, run, epoch, attempt, accepted, rejected, first_stamp,
    last_stamp (of the accepted rows; NULL if there are none), written_at."""
    log = open_log(spark, path)
    parts = [spark.createDataFrame([], METRICS)]
    if log.generation:
        parts.append(spark.read.schema(METRICS).parquet(f"{log.generation}/records"))
    if log.added:
        parts.append(spark.read.schema(METRICS).json([record_path(path, *pair) for pair in sorted(log.added)]))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.withColumns({c: F.timestamp_micros(c) for c in ("first_stamp", "last_stamp", "written_at")})


# Generations -------------------------------------------------------------------------------

def write_generation(spark, log, rows, partitions=(), latest=None):
    """Store ``rows``, made of all of the log, as its next generation.

    ``latest`` (rows with one row per key, the key, a number of buckets) is stored beside them, in buckets by key.
    """
    numbers = [int(n.partition("=")[2]) for n in folder_names(spark, log.path)
               if n.startswith("generation=")]
    number = max(numbers, default=-1) + 1
    target = f"{log.path}/generation={number}"
    rows, seen = measured(rows)
    rows.write.mode("errorifexists").partitionBy(*partitions).parquet(f"{target}/rows")
    added = [{n.split()[0]: r.get(n.split()[0]) for n in METRICS.split(", ")} for r in log.added.values()]
    records = spark.createDataFrame(added, METRICS)
    if log.generation:
        records = records.unionByName(spark.read.schema(METRICS).parquet(f"{log.generation}/records"))
    records.coalesce(1).write.mode("errorifexists").parquet(f"{target}/records")
    content = {"epochs": log.epochs.to_json(), **dict(seen.get)}
    if latest:
        current, key, buckets = latest
        write_clustered(current, f"{target}/latest", key, buckets)
        content["latest"] = {"key": key, "buckets": buckets}
    publish(spark, _generation_record(log.path, number), content)
    return target


def read_generation_latest(spark, log, schema):
    """The latest row per key of the log's generation, in buckets; None if it holds none."""
    if not log.generation:
        return None
    number = log.generation.rpartition("=")[2]
    held = read_json(spark, _generation_record(log.path, number)).get("latest")
    if not held:
        return None
    return read_clustered(spark, f"{log.generation}/latest", schema, held["key"], held["buckets"])


def drop_held(spark, path):
    """Delete the generations before the last one, and the epochs that they hold.

    What only the last generation holds stays for one more round, so that a reader which began before the last
    compaction can finish. Folders go before records: an epoch without a folder is not missed.
    """
    recorded = _recorded(spark, path)
    for number in generations(spark, path)[:-1]:
        held = _held(spark, path, number)
        for run, epoch in sorted(p for p in recorded if p in held):
            delete_folder(spark, f"{path}/run={run}/epoch={epoch}")
            delete_folder(spark, record_path(path, run, epoch))
        forget_clustered(spark, f"{path}/generation={number}/latest")
        delete_folder(spark, f"{path}/generation={number}")
        delete_folder(spark, _generation_record(path, number))
