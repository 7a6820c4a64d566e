"""Append to a Cassandra keyspace; the connector must be on the classpath."""

from dataclasses import dataclass, field

from gaugewright.operators.decode import accepted, decode
from gaugewright.schemas import WIDE_COLUMN
from gaugewright.sinks.history import RejectSink, save_with_rejects

FORMAT = "org.apache.spark.sql.cassandra"


@dataclass(frozen=True)
class KeyspaceTarget:
    """``connection`` holds ``spark.cassandra.*`` settings: host, port, credentials."""

    keyspace: str
    connection: dict = field(default_factory=dict)

    def options(self, table):
        return {"keyspace": self.keyspace, "table": table, **self.connection}


@dataclass(frozen=True)
class WideColumnSink:
    """Append accepted rows; rejects go to the folder ``rejects``. The hashed id is the primary key,
    so a replayed row overwrites itself; ``ids="random"`` gives a new id each time."""

    target: KeyspaceTarget
    topic: str
    rejects: str
    ids: str = "hashed"

    def rows(self, messages):
        return accepted(decode(messages, self.topic, WIDE_COLUMN, self.ids))

    def _append(self, messages):
        (
            self.rows(messages).write.format(FORMAT).mode("append")
            .options(**self.target.options(self.topic)).save()
        )

    def __call__(self, messages, run, epoch):
        rejected = RejectSink(self.rejects, self.topic, WIDE_COLUMN)
        save_with_rejects(self._append, rejected, messages, run, epoch)
