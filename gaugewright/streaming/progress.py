"""A log line per finished batch."""

import logging

from pyspark.sql.streaming import StreamingQueryListener

log = logging.getLogger("gaugewright.progress")


class BatchLog(StreamingQueryListener):
    """Add with ``spark.streams.addListener(BatchLog())``."""

    def onQueryStarted(self, event):
        log.info("%s started", event.name)

    def onQueryProgress(self, event):
        p = event.progress
        log.info("%s epoch %s: %s rows, %.0f rows/s", p.name, p.batchId, p.numInputRows,
                 p.processedRowsPerSecond or 0)

    def onQueryTerminated(self, event):
        if event.exception:
            log.error("query %s failed: %s", event.id, event.exception)
        else:
            log.info("query %s ended", event.id)
