from datetime import datetime, timedelta, timezone

import pytest
from plans import metadata

from tideline.functions import predicates as P
from tideline.functions.predicates import Clause

ROWS = [
    (1, "10", "red", 5, datetime(2024, 3, 15, 10, 0, 0, 250000)),
    (2, "9", "", 7, datetime(2024, 3, 15, 10, 0, 0)),
    (3, None, None, None, None),
    (4, "a^b", "dark red", 9, datetime(2024, 3, 15, 10, 0, 1)),
]
SCHEMA = "id int, code string, name string, n int, ts timestamp_ntz"
TEN = datetime(2024, 3, 15, 10)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.mark.parametrize(
    "clause, expected",
    [
        (Clause(), [1, 2, 3, 4]),
        (Clause().eq("code", 10), [1]),
        (Clause().eq("n", "5"), [1]),
        (Clause().eq("code", "a^b"), [4]),
        (Clause().eq("n", 5).or_eq("n", 7), [1, 2]),
        (Clause().ne("code", "10"), [2, 4]),
        (Clause().eq("n", 5).or_ne("name", ""), [1, 4]),
        (Clause().gt("code", "9"), [4]),
        (Clause().gt("n", "5"), [2, 4]),
        (Clause().ge("n", 7), [2, 4]),
        (Clause().lt("n", 7), [1]),
        (Clause().le("n", 7), [1, 2]),
        (Clause().is_anything("name"), [1, 2, 3, 4]),
        (Clause().is_empty_string("name"), [2]),
        (Clause().is_empty_string("n"), []),
        (Clause().is_empty("name"), [2, 3]),
        (Clause().is_empty("n"), [3]),
        (Clause().is_not_empty("name"), [1, 4]),
        (Clause().is_not_empty("n"), [1, 2, 4]),
        (Clause().ts_eq("ts", TEN), [1, 2]),
        (Clause().ts_eq("ts", TEN, "micros"), [2]),
        (Clause().between_inclusive("n", 5, 7), [1, 2]),
        (Clause().between_exclusive("n", 5, 9), [2]),
        (Clause().starts_with("name", "r"), [1]),
        (Clause().like("name", "red"), [1, 4]),
        (Clause().not_like("name", "dark"), [1, 2]),
        (Clause().gt("n", 4).eq("name", "red").or_eq("name", ""), [1, 2]),
        (Clause().eq("n", 5).union(Clause().eq("name", "red")), [1]),
        (Clause().eq("n", 5).union(Clause().gt("n", 7).union(Clause().eq("id", 3))), [1, 3, 4]),
    ],
)
def test_rows(rows, clause, expected):
    assert sorted(r.id for r in rows.where(clause.on(rows)).collect()) == expected


def test_or_needs_a_predicate_before_it():
    with pytest.raises(ValueError):
        Clause().or_eq("n", 1)


def test_unknown_field_is_an_error(rows):
    for predicate in (P.eq("nope", 1), P.is_anything("nope")):
        with pytest.raises(Exception):
            predicate(rows.schema)


def test_clauses_are_values(rows):
    base = Clause().gt("n", 4)
    base.eq("n", 5)
    assert rows.where(base.on(rows)).count() == 3


def test_aware_datetimes_are_utc(rows):
    east = timezone(timedelta(hours=5))
    assert rows.where(P.eq("ts", datetime(2024, 3, 15, 15, tzinfo=east))(rows.schema)).count() == 1


def test_instant_columns_and_text_columns(spark):
    spark_ts = spark.sql("SELECT TIMESTAMP '2024-03-15 10:00:00Z' AS at, '2024-03-15 10:00:00' AS text")
    assert spark_ts.where(P.eq("at", TEN)(spark_ts.schema)).count() == 1
    assert spark_ts.where(P.ts_eq("text", TEN)(spark_ts.schema)).count() == 1


def test_comparisons_reach_the_scan(spark, sample):
    orders = spark.read.parquet(f"{sample}/orders.parquet")
    clause = Clause().ge("o_orderdate", TEN).eq("o_custkey", "7").or_eq("o_custkey", 8).ts_eq("o_orderdate", TEN)
    pushed = next(x for x in metadata(orders.where(clause.on(orders))).splitlines() if "PushedFilters" in x)
    assert "GreaterThanOrEqual(o_orderdate" in pushed and "LessThan(o_orderdate" in pushed
    assert "Or(EqualTo(o_custkey,7),EqualTo(o_custkey,8))" in pushed
