"""Filter vocabulary, ordering, limits, unions and table reads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from tideline.catalog.base import Query, table
from tideline.functions.predicates import Clause, is_empty_string
from tideline.operators.reads import positions, project, read_records, strip_links
from tideline.sources.tables import decode_envelopes
from tideline.specs import TableSpec


def _where(name: str, clause, **kwargs):
    def run(spark, folder):
        return read_records(table(spark, folder, name), clause, **kwargs)

    return run


def _states(spark, folder):
    """Events with a state that is NULL, empty or a value."""
    kind = F.col("event_type")
    state = F.when(kind == "error", F.lit(None)).when(kind == "view", F.lit("")).otherwise(kind)
    return table(spark, folder, "events").select("event_id", state.alias("state"))


STATES = """(SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN '' ELSE event_type END AS state
  FROM events)"""


def _state_query(clause: Clause, condition: str) -> Query:
    return Query(
        lambda s, f: read_records(_states(s, f), clause), f"SELECT * FROM {STATES} WHERE {condition}"
    )


def _carets(spark, folder):
    parts = table(spark, folder, "part")
    named = parts.withColumn("p_name", F.replace("p_name", F.lit(" "), F.lit("^")))
    return read_records(named, Clause().like("p_name", "^ri"))


def _links(spark, folder):
    customers = table(spark, folder, "customer")
    linked = customers.withColumn(
        "c_nationkey",
        F.struct(F.concat(F.lit("/nation/"), "c_nationkey").alias("link"), F.col("c_nationkey").alias("value")),
    )
    return strip_links(linked)


def _envelopes(spark, folder):
    empty = F.col("event_type") == "error"
    body = F.concat(F.lit('{"result":['), F.when(empty, F.lit("")).otherwise(F.col("props")), F.lit("]}"))
    responses = table(spark, folder, "events").select(body.alias("body"))
    return decode_envelopes(responses, "body").select(F.col("record")["k"].alias("k"))


def _union(spark, folder):
    either = Clause().eq("o_orderstatus", "F").gt("o_totalprice", 100000).union(Clause().eq("o_orderpriority", "1-URGENT"))
    return read_records(table(spark, folder, "orders"), either)


D97, D98 = datetime(1997, 1, 1), datetime(1998, 1, 1)
HALF = datetime(2024, 1, 1, 8, 30, 5)
YEAR_97 = "TIMESTAMP '1997-01-01' AND TIMESTAMP '1998-01-01'"

QUERIES = {
    "read_records": Query(
        _where(
            "orders",
            Clause().eq("o_orderstatus", "F"),
            order=[("o_orderdate", "desc"), ("o_orderkey", "asc")],
            offset=100,
            limit=50,
            fields=["o_orderkey", "o_orderdate"],
        ),
        """SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderstatus = 'F'
           ORDER BY o_orderdate DESC, o_orderkey LIMIT 50 OFFSET 100""",
    ),
    "decode_envelopes": Query(_envelopes, "SELECT props->>'k' AS k FROM events WHERE event_type <> 'error'"),
    "strip_links": Query(_links, "SELECT * FROM customer"),
    "filter_eq": Query(
        _where("part", Clause().eq("p_size", "11")), "SELECT * FROM part WHERE p_size = 11"
    ),
    "filter_or_eq": Query(
        _where("part", Clause().eq("p_size", 11).or_eq("p_brand", "Brand#4")),
        "SELECT * FROM part WHERE p_size = 11 OR p_brand = 'Brand#4'",
    ),
    "filter_ne": Query(_where("customer", Clause().ne("c_mktsegment", "MACHINERY")),
        "SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY'"),
    "filter_or_ne": Query(
        _where("customer", Clause().eq("c_nationkey", 3).or_ne("c_mktsegment", "MACHINERY")),
        "SELECT * FROM customer WHERE c_nationkey = 3 OR c_mktsegment <> 'MACHINERY'",
    ),
    "filter_gt": Query(_where("supplier", Clause().gt("s_acctbal", "1000")),
        "SELECT * FROM supplier WHERE s_acctbal > 1000"),
    "filter_ge": Query(_where("part", Clause().ge("p_size", 25)), "SELECT * FROM part WHERE p_size >= 25"),
    "filter_lt": Query(_where("part", Clause().lt("p_size", "9")), "SELECT * FROM part WHERE p_size < 9"),
    "filter_le": Query(_where("supplier", Clause().le("s_acctbal", 1000)),
        "SELECT * FROM supplier WHERE s_acctbal <= 1000"),
    "filter_is_anything": _state_query(Clause().is_anything("state"), "TRUE"),
    "filter_is_empty_string": _state_query(Clause().is_empty_string("state"), "state = ''"),
    "filter_is_empty_string_number": Query(
        _where("part", Clause().eq("p_brand", "Brand#4").or_where(is_empty_string("p_size"))),
        "SELECT * FROM part WHERE p_brand = 'Brand#4'",
    ),
    "filter_is_empty": _state_query(Clause().is_empty("state"), "state IS NULL OR state = ''"),
    "filter_is_not_empty": _state_query(Clause().is_not_empty("state"), "state IS NOT NULL AND state <> ''"),
    "filter_ts_eq_second": Query(
        _where("events", Clause().ts_eq("ts", HALF)),
        "SELECT * FROM events WHERE date_trunc('second', ts) = TIMESTAMP '2024-01-01 08:30:05'",
    ),
    "filter_ts_eq_micros": Query(
        _where("orders", Clause().ts_eq("o_orderdate", datetime(1997, 5, 28), "micros")),
        "SELECT * FROM orders WHERE o_orderdate = TIMESTAMP '1997-05-28'",
    ),
    "filter_between_inclusive": Query(
        _where("orders", Clause().between_inclusive("o_orderdate", D97, D98)),
        f"SELECT * FROM orders WHERE o_orderdate BETWEEN {YEAR_97}",
    ),
    "filter_between_exclusive": Query(
        _where("orders", Clause().between_exclusive("o_orderdate", D97, D98)),
        "SELECT * FROM orders WHERE o_orderdate > TIMESTAMP '1997-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'",
    ),
    "filter_and_or": Query(
        _where("part", Clause().gt("p_size", 20).eq("p_type", "SMALL").or_eq("p_type", "ECONOMY").ne("p_brand", "Brand#4")),
        """SELECT * FROM part WHERE p_size > 20 AND (p_type = 'SMALL' OR p_type = 'ECONOMY') AND p_brand <> 'Brand#4'""",
    ),
    "filter_starts_with": Query(_where("part", Clause().starts_with("p_name", "red")),
        "SELECT * FROM part WHERE starts_with(p_name, 'red')"),
    "filter_like": Query(_where("documents", Clause().like("text", "le")),
        "SELECT * FROM documents WHERE contains(text, 'le')"),
    "filter_not_like": Query(_where("documents", Clause().not_like("text", "le")),
        "SELECT * FROM documents WHERE NOT contains(text, 'le')"),
    "filter_caret": Query(
        _carets,
        """SELECT p_partkey, replace(p_name, ' ', '^') AS p_name, p_brand, p_type, p_size, p_retailprice FROM part
           WHERE contains(replace(p_name, ' ', '^'), '^ri')""",
    ),
    "project_fields": Query(
        lambda s, f: project(
            table(s, f, "orders"), TableSpec("orders", "o_orderdate", "o_orderkey", fields=("o_totalprice",))
        ),
        "SELECT o_totalprice, o_orderdate, o_orderkey FROM orders",
    ),
    "project_all": Query(
        lambda s, f: project(table(s, f, "orders"), TableSpec("orders", "o_orderdate", "o_orderkey")),
        "SELECT * FROM orders",
    ),
    "order_asc": Query(
        lambda s, f: positions(table(s, f, "orders"), [("o_custkey", "asc"), ("o_orderkey", "asc")]),
        "SELECT *, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS row_no FROM orders",
    ),
    "order_desc": Query(
        lambda s, f: positions(table(s, f, "orders"), [("o_totalprice", "desc"), ("o_orderkey", "desc")]),
        "SELECT *, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey DESC) AS row_no FROM orders",
    ),
    "offset_all": Query(
        _where("orders", None, order=[("o_orderdate", "asc"), ("o_orderkey", "asc")], offset=200),
        "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey OFFSET 200",
    ),
    "limit_zero_is_all": Query(
        _where("customer", None, order=[("c_custkey", "asc")], limit=0, offset=-1), "SELECT * FROM customer"
    ),
    "offset_limit": Query(
        _where("orders", None, order=[("o_orderdate", "asc"), ("o_orderkey", "asc")], offset=200, limit=20),
        "SELECT * FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 20 OFFSET 200",
    ),
    "ordered_first_n": Query(
        _where("events", Clause().eq("event_type", "error"), order=[("ts", "asc"), ("event_id", "asc")], limit=20),
        "SELECT * FROM events WHERE event_type = 'error' ORDER BY ts, event_id LIMIT 20",
    ),
    "union_clauses": Query(
        _union,
        """SELECT * FROM orders WHERE (o_orderstatus = 'F' AND o_totalprice > 100000)
           OR o_orderpriority = '1-URGENT'""",
    ),
}
