"""Incoming message values: strict parsing, typed identifiers and routing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tideline.specs import RAW_EXCERPT_CHARS

# Fixed value: how Spark writes JSON numbers, booleans, arrays and objects as text.
MAYBE_UNQUOTED = r"^(-?[0-9][-+0-9.E]*|true|false|\[.*|\{.*)$"
STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


_PLAIN = r'"[^"\\\x00-\x1f]*+"'
FLAT_OBJECT = rf"\A\{{(?:{_PLAIN}:(?:{_PLAIN}|null)(?:,{_PLAIN}:(?:{_PLAIN}|null))*+)?+\}}\z"
FLAT_CHARS = 1000
"""The regular expression goes one level deeper for each field; longer texts are parsed instead."""


def flat_object(value: str) -> Column:
    """Whether the text surely is one JSON object whose values are all text or null, without escapes or white space between them.

    Most messages are, and one look tells; others may be such objects too and take further parses.
    """
    text = F.col(value)
    return (F.octet_length(text) <= FLAT_CHARS) & text.rlike(FLAT_OBJECT)


def parsed_record(value: str, flat: str | None = None) -> Column:
    """The value as MAP<STRING, STRING>; NULL unless the whole text is one JSON object.

    Spark's JSON functions stop after the first complete value and ignore what
    follows.  Read as the only element of an array, a valid text leaves just the
    closing bracket; read as a member of an object, just the closing brace.  Text
    after the object cannot start with both, so one of the two readings fails.
    A repeated field stays repeated; see ``last_values``.  ``flat`` names a column with ``flat_object`` of the value.
    """
    text = F.col(value)
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    member = F.from_json(F.concat(F.lit('{"r":'), text, F.lit("}")), "struct<r: map<string,string>>", STRICT_JSON)
    return F.when(alone if flat is None else F.col(flat) | alone, member["r"])


def last_values(record: str) -> Column:
    """The map with one entry per field: the last one where the JSON repeats it."""
    keys = F.map_keys(record)
    from_the_end = F.reverse(keys)
    last = F.filter(
        F.map_entries(record), lambda entry, i: F.array_position(from_the_end, entry["key"]) == F.size(keys) - i
    )
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)
    return F.when(repeated, F.map_from_entries(last)).otherwise(F.col(record))


def record_id(value: str, record: str, id_field: str, flat: str | None = None) -> Column:
    """The identifier of a parsed record; NULL unless it is non-empty JSON text.

    The map holds ``12`` and ``"12"`` alike, so where its text could stand for
    something else than a string the type is looked up in the JSON, if that is not flat.
    """
    typed = F.from_json(F.col(value), f"struct<`{id_field}`: variant>", STRICT_JSON)[id_field]
    text = F.col(record)[id_field]
    quoted = ~text.rlike("(?s)" + MAYBE_UNQUOTED) | (F.schema_of_variant(typed) == "STRING")
    quoted = quoted if flat is None else F.col(flat) | quoted
    return F.when((text != "") & quoted, text)


def operation(record: str, id_column: str) -> Column:
    """``update`` with an identifier, ``insert`` without, ``reject`` if unparsable."""
    return (
        F.when(F.col(record).isNull(), "reject")
        .when(F.col(id_column).isNotNull(), "update")
        .otherwise("insert")
    )


def parse_error(value: str) -> Column:
    excerpt = F.substring(F.coalesce(F.col(value), F.lit("")), 1, RAW_EXCERPT_CHARS)
    return F.concat(F.lit("deserializing record: not a JSON object (raw: "), excerpt, F.lit(")"))


def insert_id(topic: str, partition: str, offset: str) -> Column:
    """The identifier given to a new row, the same each time its message is read."""
    missing = F.raise_error(F.lit("a message without topic, partition or offset has no place to derive an identifier from"))
    place = F.concat(F.col(topic), F.lit("|"), F.col(partition).cast("string"), F.lit("|"), F.col(offset).cast("string"))
    return F.md5(F.when(place.isNull(), missing.cast("string")).otherwise(place))
