"""Reading history tables and views."""

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugewright.schemas import RELATIONAL, TOPIC_KEYS, table_schema
from gaugewright.sources.epochs import open_log, read_log
from gaugewright.sources.ranges import Epochs

ACCEPTED = "accepted"
REJECTED = "rejected"


def _stored_schema(topic, layout):
    added = StructType.fromDDL(
        "reject_reason STRING, reject_value STRING, "
        "run STRING, epoch BIGINT, kind STRING, ingest_date DATE"
    )
    return StructType(table_schema(topic, layout).fields + added.fields)


def read_stored(spark, path, topic, layout=RELATIONAL, log=None, without=Epochs()):
    """Everything a history sink wrote, accepted and rejected, with its run and epoch: the last
    compacted generation and the recorded epochs beside it, but for those in ``without``."""
    log = log or open_log(spark, path)
    return read_log(spark, log, _stored_schema(topic, layout), without)


def read_history(spark, path, topic, layout=RELATIONAL, since=None, log=None, without=Epochs()):
    """Accepted rows of a topic with ``ingest_date``; ``since`` reads only later dates' files."""
    stored = read_stored(spark, path, topic, layout, log, without).where(F.col("kind") == ACCEPTED)
    if since is not None:
        stored = stored.where(F.col("ingest_date") >= F.lit(since).cast("date"))
    return stored.select(*table_schema(topic, layout).names, "ingest_date")


def read_rejects(spark, path, topic, layout=RELATIONAL):
    return (
        read_stored(spark, path, topic, layout).where(F.col("kind") == REJECTED)
        .select("reject_reason", "reject_value", "run", "epoch")
    )


def read_dated(spark, path, topic, layout=RELATIONAL):
    """History rewritten into date folders; a filter on ``ingest_date`` selects folders."""
    fields = table_schema(topic, layout).fields + StructType.fromDDL("ingest_date DATE").fields
    return spark.read.schema(StructType(fields)).parquet(path)


# How a database takes a text's hash, by the name in its URL; {key} is the column. Other databases' users name theirs.
KEY_HASHES = {
    "postgresql": "(hashtext({key}) & 2147483647)",
    "mysql": "crc32({key})",
    "mariadb": "crc32({key})",
}
# The tables' columns are created with quoted names in capitals.
QUOTES = {"postgresql": '"{0}"', "mysql": "`{0}`", "mariadb": "`{0}`"}


def key_conditions(url, key, parts, key_hash=None):
    """Conditions that split a table by the hash of its key, however the keys are spread; NULL keys, which no view
    shows, are in none. ``key_hash`` is SQL with ``{key}`` for the column, needed where the database is not known."""
    kind = url.split(":")[1] if url.startswith("jdbc:") else ""
    pattern = key_hash or KEY_HASHES.get(kind)
    if pattern is None:
        raise ValueError(f"name the SQL that hashes a key in {kind or url!r}: an unsplit history is read by one task")
    value = pattern.format(key=QUOTES.get(kind, "{0}").format(key.upper()))
    return [f"{value} % {parts} = {part}" for part in range(parts)]


def read_jdbc_history(spark, target, topic, parts=None, key_hash=None):
    """The history of a topic, as many tasks as ``parts`` (by default the target's connections) reading it by key."""
    conditions = key_conditions(target.url, TOPIC_KEYS[topic], parts or target.connections, key_hash)
    return read_jdbc(spark, target, topic, conditions)


def read_jdbc(spark, target, table, split=None):
    """A table or view of a relational database; filters and columns are pushed to it.

    ``split`` is ``(column, lower, upper, parts)``: a numeric or time column to read by in
    parallel; or a list of conditions of the database, one per task, which together hold for every row once (see
    ``key_conditions``). Without it one task reads all: right for a view with a row per station, not for a history.
    """
    options = target.read_options(table)
    if isinstance(split, list):
        named = {name: options.pop(name) for name in ("url", "dbtable")}
        return spark.read.jdbc(named["url"], named["dbtable"], predicates=split, properties=options)
    if split:
        column, lower, upper, parts = split
        options.update(partitionColumn=column, lowerBound=str(lower), upperBound=str(upper),
                       numPartitions=str(parts))
    return spark.read.format("jdbc").options(**options).load()
