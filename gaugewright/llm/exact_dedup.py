"""Exact dedup with a heavy-hitter split.

Misra-Gries summaries name the digests that may be frequent; an exact count verifies them.
The verified winners (at most ``counters``) are broadcast, so rows of large groups are settled
where they lie. All other digests go through an ordinary shuffle, and none of those groups holds
more than one part in ``counters`` of the rows.

Defined cases: a NULL text counts as empty. Equal means equal after every run of
``[\\x20\\x09-\\x0D]`` is one space. The smallest id stays, a NULL id only if the group has no
other; of repeated rows with that id exactly one has ``kept``. An empty table gives no rows. A text
of any length is read whole; only its digest is shuffled.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gaugewright.llm.common import SPACE, keep_keys, row_key, stage

COUNTERS = 1024


def normalised(text):
    """The text with each run of white space as one space; NULL as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def misra_gries(values, counters):
    """One pass of a Misra-Gries summary over batches of values: {value: count lower bound}.

    A value that makes up more than one part in ``counters`` + 1 of them is in the summary.
    """
    summary = {}
    for batch in values:
        for value, n in batch.value_counts().items():
            summary[value] = summary.get(value, 0) + int(n)
        if len(summary) > counters:
            cut = sorted(summary.values(), reverse=True)[counters]
            summary = {value: n - cut for value, n in summary.items() if n > cut}
    return summary


def heavy_values(df, column, counters=COUNTERS):
    """The values of ``column`` that hold at least one part in ``counters`` of all rows.

    One summary of bounded size per task; a second level counts the named values exactly, with
    partial sums in the tasks. Returns at most ``counters`` rows (value, n).

    None is missed: summaries of 2 * ``counters`` values lose less than one part in 2 * ``counters`` of
    the rows from a count, so the lower bounds of frequent values stay above that part, and as bounds
    add up to no more than the rows, fewer than 2 * ``counters`` values are there.
    """
    room = 2 * counters
    kind = df.schema[column].dataType.simpleString()

    def summarise(batches):
        found = misra_gries((b[column] for b in batches), room)
        if found:
            yield pd.DataFrame({"value": list(found), "n": list(found.values())})

    named = (
        df.select(column).where(F.col(column).isNotNull())
        .mapInPandas(summarise, f"value {kind}, n long")
        .groupBy("value").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "value").limit(room).select("value")
    )
    total = df.count()
    exact = (
        df.join(F.broadcast(named), F.col(column) == F.col("value"))
        .groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    )
    return exact.where(F.col("n") * counters >= F.lit(total)).where("n > 1")


def group_rows(rows, key, order, counters=COUNTERS):
    """For each row of ``rows`` its group's first row and size.

    ``rows`` is a staged table; its column ``key`` is not NULL, and the struct ``order`` is unique
    within a group. Returns the columns of ``rows`` with ``group_first`` (the smallest ``order``) and
    ``group_size``.
    """
    heavy = stage(heavy_values(rows, key, counters), "heavy")
    hot_rows = rows.join(F.broadcast(heavy.select(F.col("value").alias(key))), key, "left_semi")
    winners = stage(
        hot_rows.groupBy(key).agg(F.min(order).alias("group_first"), F.count(F.lit(1)).alias("group_size")),
        "winners",
    )
    hot = rows.join(F.broadcast(winners), key)
    rest = rows.join(F.broadcast(winners.select(key)), key, "left_anti")
    group = Window.partitionBy(key)
    cold = rest.withColumns({
        "group_first": F.min(order).over(group),
        "group_size": F.count(F.lit(1)).over(group),
    })
    return hot.select(*rows.columns, "group_first", "group_size").unionByName(cold)


def exact_groups(docs, doc_id="doc_id", text="text", counters=COUNTERS):
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, row_key."""
    digests = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.sha2(normalised(F.col(text)), 256).alias("text_sha256"),
        row_key(F.col(doc_id), F.col(text)).alias("row_key"),
    )
    rows = stage(digests.withColumn("row", F.monotonically_increasing_id()), "digests")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row_key", "row")
    return group_rows(rows, "text_sha256", order, counters).select(
        "doc_id",
        F.col("group_first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("group_first.row") == F.col("row")).alias("kept"),
        "text_sha256",
        "row_key",
    )


def exact_dedup(docs, doc_id="doc_id", text="text", counters=COUNTERS):
    """``docs`` with one row of each group of equal texts, all columns unchanged."""
    groups = exact_groups(docs, doc_id, text, counters)
    keys = groups.where("kept").select(F.col("row_key").alias("key"))
    return keep_keys(docs, row_key(F.col(doc_id), F.col(text)), keys)
