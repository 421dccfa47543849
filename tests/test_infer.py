"""Types of text columns."""

import pytest

from comanda.sources.infer import bad_cells, column_types, typed, types_of

ROWS = [
    ("1", "1", "1.5", "2023-01-02", "2023-01-02 03:04:05", "true", "a", None, "1", "2024"),
    (" 22 ", "3000000000", "2", "2023-1-3", "2023-01-02", "FALSE", "1", "", "2", "1999"),
    (None, "-5", "1e3", None, "2023-01-02T03:04:05.25", None, "2", "  ", "x", "7"),
]
NAMES = ["i", "l", "d", "day", "time", "b", "s", "none", "most", "odd.name"]
TYPES = ["int", "bigint", "double", "date", "timestamp", "boolean", "string", "string", "string", "int"]


@pytest.fixture()
def text(spark):
    return spark.createDataFrame(ROWS, ", ".join(f"`{n}` string" for n in NAMES))


def test_types_and_values(spark, text):
    found = types_of(text)
    assert found == dict(zip(NAMES, TYPES))
    table = typed(text, found)
    assert [f.dataType.simpleString() for f in table.schema] == TYPES
    rows = table.collect()
    assert [r.i for r in rows] == [1, 22, None] and [r.d for r in rows] == [1.5, 2.0, 1000.0]
    assert str(rows[1].day) == "2023-01-03" and rows[1].none == "" and rows[2].time.microsecond == 250_000


def test_bad_cells_are_listed(spark, text):
    loose = types_of(text, tolerance=0.4)
    assert loose["most"] == "int" and loose["s"] == "int"
    counts = {r.column_name: (r.cells, r.bad_cells) for r in column_types(text, 0.4).collect()}
    assert counts["most"] == (3, 1) and counts["i"] == (2, 0) and counts["none"] == (0, 0)
    # NULL and blank cells are not bad.
    assert {tuple(r) for r in bad_cells(text, loose).collect()} == {("most", "x", 1), ("s", "a", 1)}
    assert bad_cells(text, {}).count() == 0
    with pytest.raises(ValueError):
        column_types(text, 1.0)


def test_a_wider_type_that_holds_more(spark):
    mixed = spark.createDataFrame([(v,) for v in ["1"] * 18 + ["1.0", "x"]], "n string")
    loose = types_of(mixed, 0.1)
    assert loose == {"n": "double"}  # int would hold enough, but not the 1.0
    assert [tuple(r) for r in bad_cells(mixed, loose).collect()] == [("n", "x", 1)]


def test_out_of_range_and_no_rows(spark, text):
    big = spark.createDataFrame([("99999999999999999999", "2023-02-30")], "n string, d string")
    assert types_of(big) == {"n": "double", "d": "string"}
    assert set(types_of(text.limit(0)).values()) == {"string"}


def test_one_scan(text):
    plan = column_types(text)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and plan.count("Exchange") == 1
