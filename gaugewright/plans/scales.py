"""The current stage scales as versions of a small table, each made of new files and the version before.

    table/checkpoint/                            of the stream that follows the folder of documents: the files seen
    table/log/run=<query>/epoch=<n>/...          what new files held, until a version has it
    table/version=<n>/attempt=<id>/...           the latest fetch per URL
    table/_records/version=<n>.json              its folder, and the epochs of the log that it holds
    table/_records/run=<query>/epoch=<n>.json    the version that an ingest batch was joined with
"""

from __future__ import annotations

import uuid

from pyspark.sql.types import StructType

from gaugewright.operators.latest import latest_by_key
from gaugewright.sources.documents import read_stage_scales
from gaugewright.sources.epochs import (
    RECORDS, delete_folder, exists, file_names, open_log, publish, read_json, read_log, record_path, write_epoch,
)
from gaugewright.sources.ranges import Epochs
from gaugewright.streaming.consume import await_all, consume

COLUMNS = "url STRING, items STRUCT<typicalRangeHigh: DOUBLE, typicalRangeLow: DOUBLE>, fetched_at TIMESTAMP"


class StageScales:
    """The latest fetch per URL of the documents in ``path``, kept in the folder ``table``.

    A restarted process goes on with the files it has not seen; a new fetch of a URL is landed as a new file. Which
    version a batch was joined with is kept, and a replay of the batch joins the same. ``options`` are of the
    stream of files, for example ``cleanSource`` to keep the listed folder short.
    """

    def __init__(self, spark, path, table, options=None, **reading):
        self.spark, self.path, self.table, self.options, self.reading = spark, path, table, options, reading
        self.empty = {"number": -1, "folder": None, "epochs": {}}

    def current(self, run=None, epoch=None):
        """``url, high, low``: of what has been landed so far, or for a batch that ran before, of what it saw."""
        if run is None:
            return self._rows(self.catch_up())
        pin = record_path(self.table, run, epoch)
        if not exists(self.spark, pin):
            publish(self.spark, pin, {"version": self.catch_up()["number"]})
            # Batches of a query follow each other: the one before this is done.
            delete_folder(self.spark, record_path(self.table, run, epoch - 2))
        return self._rows(self.version(read_json(self.spark, pin)["version"]))

    def version(self, number):
        if number < 0:
            return self.empty
        return read_json(self.spark, f"{self.table}/{RECORDS}/version={number}.json")

    def last(self):
        names = file_names(self.spark, f"{self.table}/{RECORDS}")
        numbers = [int(n[len("version="):-len(".json")]) for n in names if n.startswith("version=")]
        return self.version(max(numbers, default=-1))

    def _stored(self, version):
        if not version["folder"]:
            return self.spark.createDataFrame([], COLUMNS)
        return self.spark.read.schema(COLUMNS).parquet(f"{self.table}/{version['folder']}")

    def _rows(self, version):
        return self._stored(version).selectExpr("url", "items.typicalRangeHigh AS high", "items.typicalRangeLow AS low")

    def catch_up(self):
        """Read the files that are new and merge them into the next version; returns the last one."""
        if exists(self.spark, self.path):
            documents = read_stage_scales(self.spark, self.path, stream=True, options=self.options, **self.reading)
            await_all([consume(documents, "stage-scales", self._take, f"{self.table}/checkpoint", available_now=True,
                               name=f"stage-scales-{uuid.uuid4().hex}")])
        before = self.last()
        if not exists(self.spark, f"{self.table}/log"):
            return before
        held = Epochs.from_json(before["epochs"])
        log = open_log(self.spark, f"{self.table}/log")
        if not log.epochs - held:
            return before
        rows = read_log(self.spark, log, StructType.fromDDL(COLUMNS), without=held).unionByName(self._stored(before))
        latest = latest_by_key(rows, "url", "fetched_at", ["items"], ["url", "items", "fetched_at"])
        number = before["number"] + 1
        version = {"number": number, "folder": f"version={number}/attempt={uuid.uuid4().hex}",
                   "epochs": (held | log.epochs).to_json()}
        latest.write.mode("errorifexists").parquet(f"{self.table}/{version['folder']}")
        if not publish(self.spark, f"{self.table}/{RECORDS}/version={number}.json", version):
            raise RuntimeError(f"another process keeps the stage scales in {self.table}")
        self._forget(version, log)
        return version

    def _take(self, rows, run, epoch):
        usable = rows.where("items IS NOT NULL").select("url", "items", "fetched_at")
        write_epoch(usable, f"{self.table}/log", run, epoch, topic="stage-scales")

    def _forget(self, version, log):
        """Delete what a batch that runs, or is replayed, cannot need: it has this version or the one before, and an
        epoch of the log that both hold is not read again. The log's last epoch stays for the stream's own replays."""
        old = self.version(version["number"] - 2) if version["number"] > 1 else self.empty
        if old["folder"]:
            delete_folder(self.spark, f"{self.table}/{old['folder'].split('/')[0]}")
            delete_folder(self.spark, f"{self.table}/{RECORDS}/version={old['number']}.json")
        for run, epoch in sorted(p for p in log.recorded if p in Epochs.from_json(old["epochs"])):
            delete_folder(self.spark, f"{self.table}/log/run={run}/epoch={epoch}")
            delete_folder(self.spark, record_path(f"{self.table}/log", run, epoch))
