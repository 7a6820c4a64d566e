"""Current state kept by a stream, so that a reader need not scan the history."""

from pyspark.sql import functions as F

from gaugewright.operators.decode import accepted, decode
from gaugewright.operators.latest import latest_by_key
from gaugewright.schemas import TOPIC_KEYS, table_schema
from gaugewright.session import STATE_STORE
from gaugewright.sources.epochs import drop_held, open_log, read_log, write_epoch, write_generation
from gaugewright.streaming.consume import TRIGGER, run_id

ORDER = ["sequence", "pk_id"]
# Epochs between two compactions of the change log.
COMPACT_EVERY = 100


def latest_state(messages, topic):
    """Streaming DataFrame of the latest row per key: one row of state per key."""
    return latest_by_key(accepted(decode(messages, topic)), TOPIC_KEYS[topic], "last_update", ORDER)


def start_latest_state(spark, topics, topic, path, checkpoint, trigger=TRIGGER,
                       available_now=False, partitions=None, compact_every=COMPACT_EVERY):
    """Write the keys that changed in each batch to a replay-safe change log. Without a ``path`` the state itself is all
    there is, to be read by ``read_checkpoint``.

    The query runs in a session of its own, whose state is kept on disk by RocksDB. The
    number of state ``partitions`` is fixed at the first start; on a cluster, where executors
    come and go, it must be named, on a local master it is one per core. After every
    ``compact_every`` epochs the log is replaced by its current rows, so a reader meets each key
    at most that many times and once more.
    """
    if not partitions and not spark.sparkContext.master.startswith("local"):
        raise ValueError("name the number of state partitions: it is fixed at the first start")
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set("spark.sql.shuffle.partitions",
                     str(partitions or spark.sparkContext.defaultParallelism))
    for name, value in STATE_STORE.items():
        session.conf.set(name, value)

    def save(batch, epoch):
        write_epoch(batch, path, run_id(batch), epoch, topic=topic)
        if compact_every and (epoch + 1) % compact_every == 0:
            # A replay of this epoch finds nothing added, or compacts what it wrote again.
            compact_state(batch.sparkSession, path, topic)

    writer = (
        latest_state(topics.read_stream(session, topic), topic)
        .writeStream.queryName(f"{topic}_state")
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
    )
    writer = writer.foreachBatch(save) if path else writer.format("noop")
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def read_checkpoint(spark, checkpoint, topic, batch=None):
    """The current row per key straight out of a query's state, as its last finished batch, or ``batch``, left it.

    Each of the state's partitions is read by a task of its own; nothing is sorted or shuffled, and the query may
    run on. A checkpoint that holds no state of this topic is an error.
    """
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", str(batch))
    state = reader.load(checkpoint)
    key, names = TOPIC_KEYS[topic], table_schema(topic).names
    # The aggregate keeps the row, then what it is ordered by.
    held = state.schema["value"].dataType.fields[0]
    found = {*state.schema["key"].dataType.names, *getattr(held.dataType, "names", ())}
    if found != set(names):
        raise ValueError(f"{checkpoint} holds no current rows of {topic}: its state has {sorted(found)}")
    return state.select(*[F.col(f"key.{n}") if n == key else F.col(f"value.{held.name}.{n}") for n in names])


def read_changes(spark, path, topic, log=None):
    """The change log: its last generation and the epochs since."""
    return read_log(spark, log or open_log(spark, path), table_schema(topic))


def read_state(spark, path, topic, log=None):
    """The current row per key, from the change log."""
    changes = read_changes(spark, path, topic, log)
    return latest_by_key(changes, TOPIC_KEYS[topic], "last_update", ORDER, table_schema(topic).names)


def compact_state(spark, path, topic):
    """Store the current rows as the log's next generation, and delete what is two generations old.

    The query may run on; its later epochs are read beside the generation.
    """
    log = open_log(spark, path)
    if not log.added:
        return None
    target = write_generation(spark, log, read_state(spark, path, topic, log))
    drop_held(spark, path)
    return target
