"""Join of many rows to a table with one row per key."""

from pyspark.sql import functions as F


def same_key(row_key, lookup_key):
    """Join condition for a lookup whose keys may be very unevenly used.

    Where the lookup side was just aggregated by its key, Spark would join on that
    partitioning, and adaptive execution splits a skewed partition only if both sides were
    shuffled for the join. Asking for the key's hash as well makes it shuffle both. The
    lookup side, one row per key, is the small one; a key that holds a third of the other
    side's rows is then split over many tasks. Nothing is broadcast unless Spark finds the side
    below its threshold.
    """
    return (row_key == lookup_key) & (F.xxhash64(row_key) == F.xxhash64(lookup_key))
