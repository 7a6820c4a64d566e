"""Append to a relational database over JDBC; the driver jar must be on the classpath."""

from dataclasses import dataclass

from gaugewright.operators.decode import accepted, decode
from gaugewright.schemas import RELATIONAL
from gaugewright.sinks.history import RejectSink, save_with_rejects

# Columns the database fills itself or does not have.
NOT_SENT = ("pk_id", "sequence")


@dataclass(frozen=True)
class JdbcTarget:
    """Where and how to connect; credentials come from the caller's configuration."""

    url: str
    driver: str
    user: str | None = None
    password: str | None = None
    schema: str | None = None
    connections: int = 8
    batch_rows: int = 10_000

    def table(self, name):
        return f"{self.schema}.{name}" if self.schema else name

    def _common(self, table):
        options = {"url": self.url, "driver": self.driver, "dbtable": self.table(table)}
        if self.user is not None:
            options["user"] = self.user
        if self.password is not None:
            options["password"] = self.password
        return options

    def read_options(self, table):
        return {**self._common(table), "fetchsize": str(self.batch_rows)}

    def write_options(self, table):
        return {
            **self._common(table),
            "batchsize": str(self.batch_rows),
            "numPartitions": str(self.connections),
        }


@dataclass(frozen=True)
class JdbcSink:
    """Append accepted rows to ``schema.topic``; rejects go to the folder ``rejects``.

    The batch is decoded by all its tasks, and dealt out to the target's connections after that.
    Each connection commits by itself, so a batch that failed midway can add rows twice; the latest-row
    views hide them, since a row's stamp travels in its message.
    """

    target: JdbcTarget
    topic: str
    rejects: str

    def rows(self, messages):
        return accepted(decode(messages, self.topic, RELATIONAL)).drop(*NOT_SENT)

    def _append(self, messages):
        (
            self.rows(messages).repartition(self.target.connections)
            .write.format("jdbc").mode("append")
            .options(**self.target.write_options(self.topic)).save()
        )

    def __call__(self, messages, run, epoch):
        save_with_rejects(self._append, RejectSink(self.rejects, self.topic), messages, run, epoch)
