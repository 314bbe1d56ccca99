"""Model calls logged as JSON text, read into arrays of typed records without a Python worker.

A body may carry its records in one of five ways, looked for in this order:

    {"dataframe_records": [{...}, ...]}
    {"dataframe_split": {"columns": [...], "data": [[...], ...]}}
    {"instances": [{...}, ...]}
    {"inputs": [{...}, ...]}
    {"predictions": [number, ...]}

Text that is not JSON from end to end (or is missing) gives null; single quotes and text after the
JSON make it no JSON, bare ``NaN`` and ``Infinity`` are allowed. JSON of another shape gives an empty array.

Predictions and table cells are read one by one: what is not a number where one is expected (also a number
in quotes, or a fraction for a whole-number field) is null, and the others keep their places. Of repeated
column names of a table the last counts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from goldleaf.schemas import PREDICTION

# The keys under which records are logged, by precedence.
RECORD_KEYS = ("dataframe_records", "dataframe_split", "instances", "inputs", "predictions")


_STRICT = {"allowSingleQuotes": "false"}
# Numbers that JSON has no word for, where a value may stand.
_NO_NUMBER = r"(?<=[\[,:\s])-?(NaN|Infinity)(?=[\s,\]}])"


def _envelope(record: T.StructType) -> T.StructType:
    table = T.StructType(
        [
            T.StructField("columns", T.ArrayType(T.StringType())),
            T.StructField("data", T.ArrayType(T.ArrayType(T.VariantType()))),
        ]
    )
    special = {"dataframe_split": table, "predictions": T.ArrayType(T.VariantType())}
    return T.StructType(
        [T.StructField(key, special.get(key, T.ArrayType(record))) for key in RECORD_KEYS]
    )


def _typed(value: Column, kind: T.DataType) -> Column:
    """A JSON value as the wanted type, null if it is of another kind."""
    found = F.schema_of_variant(value)
    fits = F.lit(True)
    if isinstance(kind, T.IntegralType):
        fits = found == "BIGINT"
    elif isinstance(kind, T.NumericType):
        fits = found.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")
    return F.when(fits, F.try_variant_get(value, "$", kind.simpleString()))


def _from_table(table: Column, record: T.StructType) -> Column:
    """Rows of values become records; a value missing from a short row becomes null."""
    def cell(row: Column, field: T.StructField) -> Column:
        from_end = F.array_position(F.reverse(table["columns"]), field.name)
        place = F.size(table["columns"]) - from_end
        value = F.when(from_end > 0, F.get(row, place.cast("int")))
        return _typed(value, field.dataType).alias(field.name)

    return F.transform(table["data"], lambda row: F.struct(*(cell(row, field) for field in record.fields)))


def _from_predictions(values: Column, record: T.StructType) -> Column:
    def part(value: Column, field: T.StructField) -> Column:
        content = _typed(value, field.dataType) if field.name == PREDICTION else F.lit(None).cast(field.dataType)
        return content.alias(field.name)

    return F.transform(values, lambda value: F.struct(*(part(value, field) for field in record.fields)))


def parse_body(body: Column, record: T.StructType) -> Column:
    """Every way of carrying records as one struct; at most one field is filled as a rule."""
    return F.from_json(body, _envelope(record), _STRICT)


def json_values(body: Column) -> Column:
    """The text as the only element of an array, as texts: text after it, or a second value, shows."""
    alone = F.concat(F.lit("["), F.regexp_replace(body, _NO_NUMBER, "null"), F.lit("]"))
    return F.from_json(alone, T.ArrayType(T.StringType()), _STRICT)


def body_keys(values: Column) -> Column:
    """The names in a logged body, by its ``json_values``; none if it is JSON of another shape, null if it is no JSON."""
    is_json = F.coalesce(F.size(values) == 1, F.lit(False))
    names = F.json_object_keys(F.get(values, F.lit(0)))
    return F.when(is_json, F.coalesce(names, F.array().cast("array<string>")))


def body_records(body: Column, parsed: Column, record: T.StructType) -> Column:
    """The records of one logged request or response as ``array<record>``; ``parsed`` is ``parse_body`` of the same text."""
    return keyed_records(body_keys(json_values(body)), parsed, record)


def keyed_records(keys: Column, parsed: Column, record: T.StructType) -> Column:
    """The same from ``body_keys`` and ``parse_body`` of a text, as columns of an earlier projection.

    They are looked into from many places here, and this way they are computed once per row.
    """
    kind = T.ArrayType(record)

    def records(key: str) -> Column:
        if key == "dataframe_split":
            return _from_table(parsed[key], record).cast(kind)
        if key == "predictions":
            return _from_predictions(parsed[key], record).cast(kind)
        return parsed[key]

    found = F.when(keys.isNull(), F.lit(None).cast(kind))
    for key in RECORD_KEYS:
        found = found.when(F.array_contains(keys, key), records(key))
    return found.otherwise(F.array().cast(kind))
