"""Table comparison against brute force, with repeated keys and nulls."""

from __future__ import annotations

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from seismark.operators import quality
from seismark.schema import CURATED_SCHEMA

SCHEMA = "ids string, place string, n long"
rows_of_table = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", None]),
        st.sampled_from(["x", "y", None]),
        st.one_of(st.none(), st.integers(0, 2)),
    ),
    max_size=8,
)
few = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def text(value):
    return None if value is None else str(value)


def brute_cells(expected, actual):
    only_e = Counter(expected) - Counter(actual)
    only_a = Counter(actual) - Counter(expected)
    keyed = defaultdict(lambda: ([], []))
    for side, rows in enumerate((only_e, only_a)):
        for row in rows.elements():
            keyed[row[0]][side].append(row)
    out = Counter()
    for key, (e, a) in keyed.items():
        if len(e) == len(a) == 1:
            for i, name in ((1, "place"), (2, "n")):
                if e[0][i] != a[0][i]:
                    out[(key, name, text(e[0][i]), text(a[0][i]), "cell", 1, 1)] += 1
        else:
            issue = "missing" if not a else "surplus" if not e else "ambiguous"
            out[(key, None, None, None, issue, len(e), len(a))] += 1
    return out


@few
@given(expected=rows_of_table, actual=rows_of_table)
def test_cells_and_rows_equal_brute_force(spark, expected, actual):
    e, a = spark.createDataFrame(expected, SCHEMA), spark.createDataFrame(actual, SCHEMA)
    got = Counter(tuple(r) for r in quality.cell_match(e, a, "ids", ["place", "n"]).collect())
    assert got == brute_cells(expected, actual)
    count_e, count_a = Counter(expected), Counter(actual)
    rows = quality.row_differences(e, a, ["ids", "place", "n"]).collect()
    assert Counter(tuple(r) for r in rows) == Counter(
        (*row, count_e[row], count_a[row])
        for row in count_e.keys() | count_a.keys()
        if count_e[row] != count_a[row]
    )
    assert tuple(quality.row_count_match(e, a).first()) == (
        len(expected), len(actual), len(expected) == len(actual),
    )


def test_equal_tables_have_no_findings(spark):
    df = spark.createDataFrame([("a", "x", 1), ("b", None, None)] * 3, SCHEMA)
    assert quality.cell_match(df, df, "ids", ["place", "n"]).isEmpty()
    assert quality.head_sample_match(df, df, "ids", ["place", "n"]).isEmpty()
    assert quality.column_set_match(df, df).isEmpty()
    assert quality.dtype_match(df, df.schema).isEmpty()


def test_surplus_row_of_nulls_is_seen(spark):
    e = spark.createDataFrame([("a", "x", 1)], SCHEMA)
    a = spark.createDataFrame([("a", "x", 1), ("b", None, None)], SCHEMA)
    assert [tuple(r) for r in quality.cell_match(e, a, "ids", ["place", "n"]).collect()] == [
        ("b", None, None, None, "surplus", 0, 1)
    ]


def test_head_looks_only_at_the_first_rows(spark):
    e = spark.createDataFrame([(f"{i:03}", "x", i) for i in range(200)], SCHEMA)
    late = spark.createDataFrame([(f"{i:03}", "x", i if i < 150 else -1) for i in range(200)], SCHEMA)
    early = spark.createDataFrame([(f"{i:03}", "x", i if i else -1) for i in range(200)], SCHEMA)
    columns = ["place", "n"]
    assert quality.head_sample_match(e, late, "ids", columns).isEmpty()
    assert quality.head_sample_match(e, early, "ids", columns).count() == 2
    assert quality.head_sample_match(e, late, "ids", columns, n=200).count() == 100


def test_names_and_types(spark):
    e = spark.createDataFrame([], "a int, b string")
    a = spark.createDataFrame([], "a long, c string")
    assert [tuple(r) for r in quality.column_set_match(e, a).collect()] == [
        ("b", "missing"), ("c", "extra"),
    ]
    assert [tuple(r) for r in quality.dtype_match(a, e.schema).collect()] == [
        ("a", "int", "bigint"), ("b", "string", None), ("c", None, "string"),
    ]


def test_curated_schema_has_the_warehouse_types():
    kinds = Counter(f.dataType.simpleString() for f in CURATED_SCHEMA)
    assert kinds == {"double": 9, "int": 4, "string": 15, "timestamp_ntz": 2, "timestamp": 1}


@settings(few, max_examples=4)
@given(rows_of_table, rows_of_table)
def test_positional_match(spark, left, right):
    """Side by side in the order of key and columns, nulls first, as sorting both lists does."""
    def ordered(rows):
        return sorted(rows, key=lambda r: [(v is not None, v) for v in r])

    want = Counter()
    for i in range(max(len(left), len(right))):
        pair = [ordered(side)[i] if i < len(side) else None for side in (left, right)]
        if None in pair:
            want[i, None, None, None, "missing" if pair[1] is None else "surplus"] += 1
            continue
        for name, a, b in zip(("ids", "place", "n"), *pair, strict=True):
            if a != b:
                want[i, name, text(a), text(b), "cell"] += 1
    frames = [spark.createDataFrame(side, SCHEMA) for side in (left, right)]
    found = quality.positional_match(*frames, "ids", ["place", "n"])
    assert Counter(map(tuple, found.collect())) == want


def test_positions_run_through_all_partitions(spark):
    from seismark.operators.sorting import with_position

    rows = spark.range(0, 30_000, 1, 8).selectExpr("IF(id % 3 = 0, 7, id % 1000) AS k", "id")
    placed = with_position(rows, "k", "id")
    assert "rangepartitioning" in rows.orderBy("k", "id")._jdf.queryExecution().executedPlan().toString()
    found = [tuple(r) for r in placed.orderBy("position").select("position", "k", "id").collect()]
    want = sorted((7 if i % 3 == 0 else i % 1000, i) for i in range(30_000))
    assert found == [(n, *row) for n, row in enumerate(want)]
    assert with_position(rows.limit(0), "k").count() == 0


def test_bottom_k_sample_is_the_same_however_dealt(spark):
    base = spark.range(5000).selectExpr("id AS k", "id % 7 AS v")
    changed = base.selectExpr("k", "IF(k % 10 = 0, -1, v) AS v").where("k % 11 <> 3")
    results = [
        sorted(map(tuple, quality.bottom_k_sample_match(base.repartition(n), changed.repartition(m), "k", ["v"], 200, salt).collect()))
        for n, m, salt in ((1, 3, "a"), (6, 2, "a"), (2, 2, "b"))
    ]
    assert results[0] == results[1] != results[2]
    assert 20 < len(results[0]) < 100
    assert quality.bottom_k_sample_match(base, base.repartition(3), "k", ["v"], 200).isEmpty()
