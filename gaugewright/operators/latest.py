"""Grouped maximum, distinct-on and latest row per key."""

from pyspark.sql import Window, functions as F

from gaugewright.functions.times import utc_date
from gaugewright.session import shared_folder, work_path

# A broadcast copy of the keys' maxima may take this much memory on each executor.
BROADCAST_BYTES = 128 * 1024 * 1024
# What a row takes in the broadcast hash table beside its key's text, which is held twice: in
# the lookup key (text and time) and in the row. Two rows' fixed parts, and the pointer array.
ROW_BYTES = 140
# The most keys that Spark's runtime filter is sized for.
FILTER_KEYS = "spark.sql.optimizer.runtime.bloomFilter.maxNumItems"
# With fewer rows to a key, the second scan and the join cost more than the sort they save.
FILTER_ROWS_PER_KEY = 8


def grouped_max(df, key, column, alias="max_value"):
    """Largest value per key; partial maxima are formed before the shuffle."""
    return df.groupBy(key).agg(F.max(column).alias(alias))


def join_on_max(df, key, time):
    """The rows that carry their key's latest time, ties included; NULL keys and times drop."""
    latest = grouped_max(_with_key_and_time(df, key, time), key, time, "latest_time").select(
        F.col(key).alias("latest_key"), "latest_time"
    )
    return df.join(
        latest, (df[key] == F.col("latest_key")) & (df[time] == F.col("latest_time"))
    ).drop("latest_key", "latest_time")


def distinct_on(df, keys, order_by):
    """First row per key in the given order, NULL keys counted as equal.

    Spark limits each task's output to one row per key before the shuffle, so neither a
    frequent key nor many copies of one row gather in a task.
    """
    window = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")


def latest_by_key(df, key, time, tiebreak=(), columns=None):
    """The latest row per key, in one scan and one shuffle, lazily.

    ``max_by`` is a partial aggregate: each task sends one row per key it saw, whatever the
    number of rows or copies of that key. Also valid on a stream in update mode. Rows with a
    NULL key or time drop; equal times go to the largest tiebreak. Name the ``columns``
    wanted: Spark does not prune the fields of an aggregated struct by itself.
    """
    columns = columns or df.columns
    rest = F.struct(*[c for c in columns if c != key])
    return (
        _with_key_and_time(df, key, time)
        .groupBy(key)
        .agg(F.max_by(rest, F.struct(time, *tiebreak)).alias("_row"))
        .select(*[F.col(key) if c == key else F.col(f"_row.{c}") for c in columns])
    )


def latest_by_key_two_pass(df, key, time, tiebreak=(), columns=None, date=None,
                           broadcast_bytes=BROADCAST_BYTES):
    """Same result with two scans, for batch jobs with few keys against many rows.

    The first scan reads two columns and hashes; its result, one row per key, is stored in
    the checkpoint folder and measured. Within the bound it is broadcast, the second scan
    keeps only the rows at their key's latest time, and next to nothing is shuffled. Above
    the bound a runtime filter keeps them (see ``at_latest_by_filter``); where Spark makes none, or
    keys have few rows, the one-pass form runs. The first scan happens at once, not lazily.

    ``date`` names a partition column with the UTC date of ``time``. Then the second scan
    reads only the dates on which some key was last seen, most often a small part.
    """
    shared_folder(df.sparkSession)
    columns = columns or df.columns
    usable = _with_key_and_time(df, key, time)
    counted = usable.groupBy(F.col(key).alias("latest_key")).agg(
        F.max(time).alias("latest_time"), F.count(F.lit(1)).alias("held")).checkpoint()
    size = counted.agg(
        F.count("*").alias("rows"),
        F.sum(F.octet_length(F.col("latest_key").cast("string"))).alias("text"),
        F.sum("held").alias("held"),
    ).first()
    maxima = counted.drop("held")
    if date:
        # As many rows as there are calendar days, at most.
        days = maxima.select(utc_date("latest_time").alias("day")).distinct().collect()
        usable = usable.where(F.col(date).isin([row["day"] for row in days]))
    if broadcast_estimate(size["rows"], size["text"] or 0) > broadcast_bytes:
        at_latest = None
        if (size["held"] or 0) >= FILTER_ROWS_PER_KEY * size["rows"]:
            at_latest = at_latest_by_filter(usable, maxima, key, time, size["rows"])
        return latest_by_key(df if at_latest is None else at_latest, key, time, tiebreak, columns)
    at_latest = usable.join(
        F.broadcast(maxima),
        (usable[key] == F.col("latest_key")) & (usable[time] == F.col("latest_time")),
        "left_semi",
    )
    return latest_by_key(at_latest, key, time, tiebreak, columns)


def at_latest_by_filter(df, maxima, key, time, rows):
    """The rows at their key's latest time by a shuffled join whose scan is filtered first, or None.

    The maxima are stored as hashes of key and time, so that Spark can make a Bloom filter of them
    and put it on the scan of ``df``: what is shuffled and sorted is about one row per key, not the
    history. A row let through by equal hashes is not its key's latest, and loses later on. None if
    there are more keys than the filter is sized for, or if Spark makes no filter: it does for scans
    of ``applicationSideScanSizeThreshold`` and more, where the hashes (8 bytes a key) are above
    ``autoBroadcastJoinThreshold`` and below ``creationSideThreshold``.
    """
    spark = df.sparkSession
    if rows > int(spark.conf.get(FILTER_KEYS)):
        return None
    path = work_path(spark, "maxima")
    maxima.select(
        F.xxhash64("latest_key", "latest_time").alias("latest"), "latest_time").write.parquet(path)
    stored = spark.read.parquet(path)
    # Nothing earlier than the earliest maximum is a latest row: the scan skips such files and row
    # groups, and a filtered side is what Spark asks for before it makes a Bloom filter of it.
    first = stored.agg(F.min("latest_time").cast("string")).first()[0]
    first = F.lit(first).cast(df.schema[time].dataType)
    kept = df.where(F.col(time) >= first).join(
        stored.where(F.col("latest_time") >= first).hint("merge"),
        F.xxhash64(key, time) == F.col("latest"),
        "left_semi",
    )
    return kept if "might_contain" in kept._jdf.queryExecution().optimizedPlan().toString() else None


def broadcast_estimate(rows, text_bytes):
    """Bytes of the hash table of ``rows`` keys whose texts take ``text_bytes`` together."""
    return rows * ROW_BYTES + 2 * text_bytes


def _with_key_and_time(df, key, time):
    return df.where(F.col(key).isNotNull() & F.col(time).isNotNull())
