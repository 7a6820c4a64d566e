"""What several operators share: staged tables, free column names, row keys, texts as bytes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from gaugewright.session import work_path

# Rows of an Arrow batch. Spark's own 10,000 long texts would not fit into a worker.
BATCH_ROWS = 1000

# The contract's white space and words, as regular expressions.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def stage(df, purpose):
    """Write ``df`` to the shared folder and read it back: lineage ends, and no pass repeats."""
    path = work_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_batches(df, function, schema):
    """``mapInArrow`` in batches of at most ``BATCH_ROWS`` rows, a setting of the session that stays."""
    setting, conf = "spark.sql.execution.arrow.maxRecordsPerBatch", df.sparkSession.conf
    if not 0 < int(conf.get(setting)) <= BATCH_ROWS:
        conf.set(setting, BATCH_ROWS)
    return df.mapInArrow(function, schema)


def free_name(df, wanted):
    """``wanted``, with underscores added until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def words_of(column):
    """The number of words of a text; NULL has none."""
    return F.coalesce(F.regexp_count(column, F.lit(WORD)), F.lit(0)).cast("long")


def row_key(doc_id, text):
    """Equal for rows of equal id and text only; never NULL.

    The text goes in by its SHA-256; a NULL text differs from an empty one.
    """
    return F.concat_ws(
        ":",
        F.coalesce(doc_id.cast("string"), F.lit("-")),
        F.coalesce(F.sha2(text, 256), F.lit("-")),
    )


def keep_keys(docs, key, keys):
    """The rows of ``docs`` whose ``key`` expression is in ``keys.key``, one row for each key.

    Repeated rows are merged in the tasks before they are shuffled, so a row that makes up a
    third of the table is no hot group; the semi join uses the same partitioning.
    """
    name = free_name(docs, "row_key")
    once = docs.withColumn(name, key).dropDuplicates([name])
    return once.join(keys.select(F.col("key").alias(name)), name, "left_semi").select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )


def utf8(array):
    """All texts of an Arrow string array as one byte array, with each text's start and end.

    NULL counts as empty.
    """
    import pyarrow as pa

    array = array.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = array.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets[:-1], offsets[1:]
