"""Topics to sinks, batch by batch."""

import logging

log = logging.getLogger("gaugewright.streaming")

# Fixed value.
TRIGGER = "15 seconds"


def run_id(batch):
    """Id of the streaming query that runs this batch; it survives restarts."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def fan_out(*sinks):
    """One sink that hands a batch to several; the batch is read from its source once."""
    def save(messages, run, epoch):
        kept = messages.persist()
        try:
            for sink in sinks:
                sink(kept, run, epoch)
        finally:
            kept.unpersist()

    return save


def to_topics(topics, output, scales=None):
    """Sink for a stream of documents: ``output`` turns a batch of them into messages that
    name their topic, with the stage scales that the batch is joined with, if there are any. A replayed batch has
    the same stamps and the same scales; file topics take it once, a broker again."""
    def save(documents, run, epoch):
        messages = output(documents, scales.current(run, epoch)) if scales else output(documents)
        topics.write_epoch(messages, run, epoch)

    return save


def consume(messages, topic, sink, checkpoint, trigger=TRIGGER, available_now=False, name=None):
    """Start a query that hands each batch of messages to ``sink(batch, run, epoch)``.

    The checkpoint is required: a restarted query goes on where it stopped, and replays at most
    its last batch. ``available_now`` works off what is there, in batches, and ends. Give
    queries on one topic in one session different names.
    """
    if not checkpoint:
        raise ValueError("a checkpoint folder is required")

    def save(batch, epoch):
        sink(batch, run_id(batch), epoch)
        log.info("epoch %s: saved messages of topic %s", epoch, topic)

    writer = (
        messages.writeStream.queryName(name or topic)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(save)
    )
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=trigger).start()


def start_topics(spark, topics, sinks, checkpoint, **settings):
    """One query per topic, side by side; ``sinks`` maps topic to sink."""
    return [
        consume(topics.read_stream(spark, topic), topic, sink, f"{checkpoint}/{topic}", **settings)
        for topic, sink in sinks.items()
    ]


def await_all(queries, poll_seconds=1):
    """Wait for all queries; when one fails, stop the others and raise its error."""
    waiting = list(queries)
    try:
        while waiting:
            for query in list(waiting):
                if query.awaitTermination(poll_seconds):
                    waiting.remove(query)
    except Exception:
        for query in queries:
            if query.isActive:
                query.stop()
        raise
