"""Append-only history as Parquet, safe against replayed batches."""

from dataclasses import dataclass

from pyspark.sql import functions as F

from gaugewright.functions.times import utc_date
from gaugewright.operators.decode import accepted, decode, rejects
from gaugewright.schemas import RELATIONAL, table_schema
from gaugewright.sources.epochs import (
    drop_held,
    is_recorded,
    measured,
    open_log,
    write_epoch,
    write_generation,
)
from gaugewright.sources.history import ACCEPTED, REJECTED, read_stored

PARTITIONS = ("kind", "ingest_date")


@dataclass(frozen=True)
class HistorySink:
    """Accepted and rejected rows of a topic in one write, split by folder."""

    path: str
    topic: str
    layout: str = RELATIONAL

    def __call__(self, messages, run, epoch):
        rows = decode(messages, self.topic, self.layout)
        stamped = "last_update" in rows.columns
        dated = utc_date("last_update") if stamped else F.lit(None).cast("date")
        kind = F.when(F.col("reject_reason").isNull(), ACCEPTED).otherwise(REJECTED)
        rows = rows.withColumn("kind", kind).withColumn("ingest_date", dated)
        # One file per date, more only where a date is large.
        rows = rows.hint("rebalance", "kind", "ingest_date")
        write_epoch(rows, self.path, run, epoch, PARTITIONS, self.topic)


def compact_history(spark, path, topic, layout=RELATIONAL, drop=False, latest=None, log=None):
    """Store all epochs so far as one generation: few large files per date instead of many small.

    Readers use it at once; nothing is lost, rejects included. ``drop`` deletes what older
    generations held (see ``drop_held``). ``latest`` is stored beside it (see ``compact_current``).
    """
    log = log or open_log(spark, path)
    if not log.added:
        return None
    rows = read_stored(spark, path, topic, layout, log).hint("rebalance", "kind", "ingest_date")
    target = write_generation(spark, log, rows, PARTITIONS, latest)
    if drop:
        drop_held(spark, path)
    return target


@dataclass(frozen=True)
class RejectSink:
    """Rejected messages alone, beside a target that cannot hold them: see ``read_rejects``.

    Written after the target, its epoch's record also says that the target has the batch.
    """

    path: str
    topic: str
    layout: str = RELATIONAL

    def __call__(self, messages, run, epoch):
        rows = decode(messages, self.topic, self.layout)
        kind = F.when(F.col("reject_reason").isNull(), ACCEPTED).otherwise(REJECTED)
        # Both kinds are counted, the target's rows as well.
        rows, seen = measured(rows.withColumn("kind", kind))
        rows = rejects(rows).withColumns({"kind": F.lit(REJECTED), "ingest_date": F.lit(None).cast("date")})
        write_epoch(rows, self.path, run, epoch, PARTITIONS, self.topic, seen)

    def has(self, messages, run, epoch):
        return is_recorded(messages.sparkSession, self.path, run, epoch)


def save_with_rejects(save, rejected, messages, run, epoch):
    """``save(messages)``, then the batch's rejects. A replayed batch whose rejects are there was
    saved before and is skipped; only a failure between the two saves it twice."""
    if rejected.has(messages, run, epoch):
        return
    kept = messages.persist()
    try:
        save(kept)
        rejected(kept, run, epoch)
    finally:
        kept.unpersist()


@dataclass(frozen=True)
class TableSink:
    """Append accepted rows to a history table of the catalog (see ``create_tables``); rejects go
    to the folder ``rejects``."""

    database: str
    topic: str
    rejects: str

    def _append(self, messages):
        rows = accepted(decode(messages, self.topic)).select(
            *table_schema(self.topic).names, utc_date("last_update").alias("ingest_date")
        )
        rows.write.mode("append").insertInto(f"{self.database}.{self.topic}")

    def __call__(self, messages, run, epoch):
        save_with_rejects(self._append, RejectSink(self.rejects, self.topic), messages, run, epoch)


def rewrite_by_date(history, path):
    """Rewrite many small epoch files as few large ones per date, in a new folder.

    The rebalance gathers a date's rows, and splits a large date over several tasks at the
    advisory partition size.
    """
    (
        history.hint("rebalance", "ingest_date").write.mode("errorifexists")
        .partitionBy("ingest_date").parquet(path)
    )
