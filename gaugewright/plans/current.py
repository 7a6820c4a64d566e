"""Current rows without reading the whole history: a snapshot, or a generation's latest rows, and what came in since."""

from pyspark.sql import functions as F

from gaugewright.operators.latest import latest_by_key, latest_by_key_two_pass
from gaugewright.plans.views import refresh_latest
from gaugewright.schemas import TOPIC_KEYS, table_schema
from gaugewright.sinks.history import compact_history
from gaugewright.sources.epochs import open_log, read_epochs, read_generation_latest, write_epochs
from gaugewright.sources.history import read_history
from gaugewright.sources.ranges import Epochs

ORDER = ["sequence", "pk_id"]


def current_rows(spark, history, topic, snapshot=None, latest=latest_by_key, log=None):
    """The latest row per key with all columns of the topic's table.

    ``snapshot`` is a folder ``write_snapshot`` wrote. It knows the epochs it was made of, and only
    the others are read, however late their messages were consumed. ``log`` fixes the state of the
    history that is read, by default the present one.
    """
    log = log or open_log(spark, history)
    columns = table_schema(topic).names
    if snapshot is None and (held := read_generation_latest(spark, log, table_schema(topic))):
        added = read_history(spark, history, topic, log=log, without=log.held)
        return newer_of(held, latest_by_key(added, TOPIC_KEYS[topic], "last_update", ORDER, columns), topic)
    if snapshot is None:
        rows = read_history(spark, history, topic, log=log)
        return latest(rows, TOPIC_KEYS[topic], "last_update", ORDER, columns)
    previous = spark.read.schema(table_schema(topic)).parquet(f"{snapshot}/rows")
    seen = read_epochs(spark, f"{snapshot}/epochs")
    added = read_history(spark, history, topic, log=log, without=seen)
    return refresh_latest(previous, added, topic, latest)


def newer_of(held, fresh, topic):
    """The later of two rows per key. ``held`` is in buckets by the key and stays where it is: only ``fresh`` is moved."""
    key, names = TOPIC_KEYS[topic], table_schema(topic).names
    h, f = held.alias("h"), fresh.alias("f")
    order = ["last_update", *ORDER]
    later = F.struct(*[F.col(f"f.{c}") for c in order]) > F.struct(*[F.col(f"h.{c}") for c in order])
    take = F.col(f"h.{key}").isNull() | (F.col(f"f.{key}").isNotNull() & later)
    return h.join(f, F.col(f"h.{key}") == F.col(f"f.{key}"), "full_outer").select(
        *[F.when(take, F.col(f"f.{c}")).otherwise(F.col(f"h.{c}")).alias(c) for c in names])


def compact_current(spark, history, topic, buckets=None, latest=latest_by_key, drop=False):
    """Compact a history, and keep the latest row per key of what the generation holds in buckets by key.

    These come from the ones of the generation before and the epochs since: the history is not read for them. After
    that, ``current_rows`` reads one row per key and the epochs since; a hot key is one row like any other. The number of
    ``buckets`` is by default that of shuffle partitions: Spark joins buckets in place only if they are no fewer.
    """
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    log = open_log(spark, history)
    if not log.added:
        return None
    current = current_rows(spark, history, topic, latest=latest, log=log)
    return compact_history(spark, history, topic, drop=drop, latest=(current, TOPIC_KEYS[topic], buckets), log=log)


def write_snapshot(spark, history, topic, path, snapshot=None, latest=latest_by_key):
    """Keep the current rows, and which epochs they come from, in a new folder."""
    log = open_log(spark, history)
    rows = current_rows(spark, history, topic, snapshot, latest, log)
    rows.write.mode("errorifexists").parquet(f"{path}/rows")
    seen = read_epochs(spark, f"{snapshot}/epochs") if snapshot else Epochs()
    write_epochs(spark, seen | log.epochs, f"{path}/epochs")


def two_pass_by_date(df, key, time, tiebreak=(), columns=None):
    """The two-pass form for rows with their history's ``ingest_date``."""
    date = "ingest_date" if "ingest_date" in df.columns else None
    return latest_by_key_two_pass(df, key, time, tiebreak, columns, date=date)
