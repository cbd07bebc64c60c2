"""Table comparisons of ``orders`` with a changed copy of itself.

The copy lacks the most expensive orders, has a new priority on those of status P, and holds late
orders a second time under keys of their own.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from seismark.operators import quality
from seismark.session import work_folder
from seismark.sinks.files import write_json_rows
from seismark.sources.tables import read_json_strings_inferred
from seismark.workload.registry import query, table

COLUMNS = ["o_custkey", "o_orderstatus", "o_orderpriority"]

CHANGED_SQL = """
    SELECT o_orderkey, o_custkey, o_orderstatus,
           CASE WHEN o_orderstatus = 'P' THEN '1-URGENT' ELSE o_orderpriority END
               AS o_orderpriority
    FROM orders WHERE o_totalprice < 450000
    UNION ALL
    SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_orderpriority
    FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01'
"""
EXPECTED_SQL = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders"


def _orders(spark, sf):
    orders = table(spark, sf, "orders")
    kept = orders.filter(F.col("o_totalprice") < 450000).withColumn(
        "o_orderpriority",
        F.when(F.col("o_orderstatus") == "P", "1-URGENT").otherwise(F.col("o_orderpriority")),
    )
    late = orders.filter(F.col("o_orderdate") >= F.lit("2001-06-01").cast("timestamp_ntz"))
    return orders, kept.unionByName(late.withColumn("o_orderkey", -1 - F.col("o_orderkey")))


def cell_sql(key: str, columns: list[str]) -> str:
    """Differences by key, stated with EXCEPT ALL and an outer join."""
    listed = ", ".join([key, *columns])
    pick = ", ".join(f"any_value({c}) AS {c}" for c in columns)
    cells = " UNION ALL ".join(
        f"SELECT {key}, '{c}' AS column_name, CAST(e_{c} AS VARCHAR) AS expected, "
        f"CAST(a_{c} AS VARCHAR) AS actual, 'cell' AS issue, n_expected, n_actual FROM paired "
        f"WHERE n_expected = 1 AND n_actual = 1 AND e_{c} IS DISTINCT FROM a_{c}"
        for c in columns
    )
    sides = ", ".join(f"e.{c} AS e_{c}, a.{c} AS a_{c}" for c in columns)
    return f"""
    WITH expected AS (SELECT {listed} FROM ({EXPECTED_SQL})),
    actual AS (SELECT {listed} FROM ({CHANGED_SQL})),
    e AS (SELECT {key}, count(*) AS n, {pick}
          FROM (SELECT * FROM expected EXCEPT ALL SELECT * FROM actual) GROUP BY {key}),
    a AS (SELECT {key}, count(*) AS n, {pick}
          FROM (SELECT * FROM actual EXCEPT ALL SELECT * FROM expected) GROUP BY {key}),
    paired AS (SELECT coalesce(e.{key}, a.{key}) AS {key}, coalesce(e.n, 0) AS n_expected,
                      coalesce(a.n, 0) AS n_actual, {sides}
               FROM e FULL JOIN a ON e.{key} = a.{key})
    {cells}
    UNION ALL
    SELECT {key}, NULL, NULL, NULL,
           CASE WHEN n_actual = 0 THEN 'missing' WHEN n_expected = 0 THEN 'surplus'
                ELSE 'ambiguous' END,
           n_expected, n_actual
    FROM paired WHERE NOT (n_expected = 1 AND n_actual = 1)
    """


@query(
    f"SELECT (SELECT count(*) FROM orders) AS expected_rows, "
    f"(SELECT count(*) FROM ({CHANGED_SQL})) AS actual_rows, "
    f"(SELECT count(*) FROM orders) = (SELECT count(*) FROM ({CHANGED_SQL})) AS matches"
)
def row_count_match(spark, sf):
    return quality.row_count_match(*_orders(spark, sf))


@query(cell_sql("o_orderkey", COLUMNS))
def cell_mismatches(spark, sf):
    return quality.cell_match(*_orders(spark, sf), "o_orderkey", COLUMNS)


@query(cell_sql("o_custkey", ["o_orderstatus", "o_orderpriority"]))
def cell_mismatches_repeated_key(spark, sf):
    """A key that is not unique: differing rows of one key may have no pairing."""
    return quality.cell_match(
        *_orders(spark, sf), "o_custkey", ["o_orderstatus", "o_orderpriority"]
    )


_MULTISET_DIFFERENCE = """
    SELECT {columns}, sum(e)::BIGINT AS expected_copies, sum(a)::BIGINT AS actual_copies FROM (
        SELECT {columns}, 1 AS e, 0 AS a FROM ({expected})
        UNION ALL SELECT {columns}, 0, 1 FROM ({actual}))
    GROUP BY {columns} HAVING sum(e) <> sum(a)
"""


@query(
    _MULTISET_DIFFERENCE.format(
        columns="o_custkey, o_orderstatus, o_orderpriority",
        expected=EXPECTED_SQL,
        actual=CHANGED_SQL,
    )
)
def row_differences(spark, sf):
    return quality.row_differences(*_orders(spark, sf), COLUMNS)


_HEAD = "SELECT * FROM ({source}) ORDER BY o_orderkey, o_custkey, o_orderstatus LIMIT 100"


@query(
    _MULTISET_DIFFERENCE.format(
        columns="o_orderkey, o_custkey, o_orderstatus, o_orderpriority",
        expected=_HEAD.format(source=EXPECTED_SQL),
        actual=_HEAD.format(source=CHANGED_SQL),
    )
)
def head_sample_match(spark, sf):
    return quality.head_sample_match(*_orders(spark, sf), "o_orderkey", COLUMNS, n=100)


def _inferred_copy(spark, sf):
    """The copy without its customer, as JSON rows whose schema is inferred from all of them."""
    path = work_folder(spark, "rows")
    _, changed = _orders(spark, sf)
    write_json_rows(changed.drop("o_custkey").withColumn("note", F.lit("copy")), path)
    return read_json_strings_inferred(spark, path)


@query("SELECT * FROM (VALUES ('o_custkey', 'missing'), ('note', 'extra')) t(name, side)")
def column_set_match(spark, sf):
    return quality.column_set_match(table(spark, sf, "orders"), _inferred_copy(spark, sf))


@query(
    "SELECT * FROM (VALUES ('note', NULL, 'string'), ('o_custkey', 'bigint', NULL), "
    "('o_orderdate', 'timestamp_ntz', 'string')) t(name, expected, actual)"
)
def dtype_match(spark, sf):
    declared: T.StructType = table(spark, sf, "orders").schema
    return quality.dtype_match(_inferred_copy(spark, sf), declared)


def _numbered(source: str) -> str:
    columns = "o_custkey, o_orderstatus, o_orderpriority"
    return f"SELECT row_number() OVER (ORDER BY {columns}) - 1 AS position, {columns} FROM ({source})"


def positions_sql() -> str:
    cells = " UNION ALL ".join(
        f"SELECT position, '{c}' AS column_name, CAST(e.{c} AS VARCHAR) AS expected, CAST(a.{c} AS VARCHAR) AS actual, "
        f"'cell' AS issue FROM e JOIN a USING (position) WHERE e.{c} IS DISTINCT FROM a.{c}"
        for c in COLUMNS
    )
    return f"""
    WITH e AS ({_numbered(EXPECTED_SQL)}), a AS ({_numbered(CHANGED_SQL)}) {cells}
    UNION ALL SELECT position, NULL, NULL, NULL, 'missing' FROM e WHERE position NOT IN (SELECT position FROM a)
    UNION ALL SELECT position, NULL, NULL, NULL, 'surplus' FROM a WHERE position NOT IN (SELECT position FROM e)
    """


@query(positions_sql())
def cell_positions(spark, sf):
    """Rows paired by their place in the order of a key that repeats."""
    return quality.positional_match(*_orders(spark, sf), "o_custkey", COLUMNS)


_DRAWN = "md5('2024|' || o_orderkey::VARCHAR)"
_SAMPLED = f"""SELECT * FROM ({{source}}) WHERE {_DRAWN} <= (SELECT max(h) FROM (
    SELECT DISTINCT {_DRAWN} AS h FROM (SELECT o_orderkey FROM ({EXPECTED_SQL}) UNION SELECT o_orderkey FROM ({CHANGED_SQL}))
    ORDER BY h LIMIT 100))"""


@query(
    _MULTISET_DIFFERENCE.format(
        columns="o_orderkey, o_custkey, o_orderstatus, o_orderpriority",
        expected=_SAMPLED.format(source=EXPECTED_SQL),
        actual=_SAMPLED.format(source=CHANGED_SQL),
    )
)
def bottom_k_sample_match(spark, sf):
    return quality.bottom_k_sample_match(*_orders(spark, sf), "o_orderkey", COLUMNS, 100, "2024")
