"""Compare a Spark result with DuckDB's, column by column name, as unordered rows."""

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


# What a table holds in the skewed copy: a third of its rows on one key, thousands of copies
# of one row, and NULL keys or times.
_SKEWED = {
    "events": """SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 7 ELSE user_id END AS user_id)
        FROM events
        UNION ALL SELECT e.* FROM events e, range(3000) WHERE event_id = 500
        UNION ALL SELECT * REPLACE (NULL AS ts) FROM events
        WHERE event_id < 50 AND event_type = 'error'""",
    "orders": """SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END
        AS o_custkey) FROM orders
        UNION ALL SELECT o.* FROM orders o, range(3000) WHERE o_orderkey = 500
        UNION ALL SELECT * REPLACE (NULL AS o_custkey) FROM orders WHERE o_orderkey < 50""",
    "customer": """SELECT * REPLACE (CASE WHEN c_custkey % 3 = 0 THEN 3 ELSE c_nationkey END
        AS c_nationkey) FROM customer""",
    "supplier": """SELECT * REPLACE (CASE WHEN s_suppkey % 3 = 0 THEN 3 ELSE s_nationkey END
        AS s_nationkey) FROM supplier""",
}


def write_skewed(sf_dir, target):
    """A copy of the tables with hot keys, copies and NULLs."""
    connection = duck(sf_dir)
    for name in TABLES:
        rows = _SKEWED.get(name, f"SELECT * FROM {name}")
        connection.execute(f"COPY ({rows}) TO '{target}/{name}.parquet' (FORMAT parquet)")


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(result, connection, sql):
    """None if equal, else a short account."""
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = _rows(names, cursor.fetchall())
    if sorted(names) != sorted(result.columns):
        return f"columns {sorted(result.columns)} != {sorted(names)}"
    got = _rows(result.columns, [tuple(r) for r in result.collect()])
    if got == expected:
        return None
    missing, extra = expected - got, got - expected
    return (f"{sum(got.values())} rows, expected {sum(expected.values())}; "
            f"missing {list(missing)[:2]}, extra {list(extra)[:2]}")
