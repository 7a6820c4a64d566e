"""Tables in buckets by a key: a join or an aggregate by that key needs no exchange of them.

Spark knows buckets from its catalog only. So a reader declares the folder there as an external table, under a name
that comes from the folder; the files are the same for every reader, and dropping the table leaves them.
"""

from __future__ import annotations

import hashlib

from pyspark.sql.types import StructType

DATABASE = "gaugewright_clustered"


def _name(folder):
    return f"{DATABASE}.t_{hashlib.sha256(folder.encode()).hexdigest()[:24]}"


def write_clustered(rows, folder, key, buckets):
    """Store ``rows`` in ``folder``, one file per bucket of the key. For tables with one row per key, or few."""
    spark = rows.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
    (
        rows.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
        .option("path", folder).mode("errorifexists").saveAsTable(_name(folder))
    )


def read_clustered(spark, folder, schema: StructType, key, buckets):
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = folder.replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_name(folder)} ({columns}) USING parquet "
              f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{place}'")
    return spark.table(_name(folder))


def forget_clustered(spark, folder):
    """Take the folder's table out of the catalog, where it was declared."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(folder)}")
