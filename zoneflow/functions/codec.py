"""Flat JSON messages: encoding, and decoding with the validity rules of a typed table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zoneflow.functions.clock import iso
from zoneflow.functions.numbers import nan_to_null
from zoneflow.schemas import Contract

# Text a database accepts for a number or a timestamp. Spark's own casts are
# wider (`1d`, a bare year).
NUMBER_TEXT = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
STAMP_TEXT = r"^\s*\d{4}-\d{1,2}-\d{1,2}"


def encode_messages(
    df: DataFrame, key_col: str, columns: list[str], carry: list[str] | None = None
) -> DataFrame:
    """(key, value) messages: NaN is written as null, and nulls are written, not dropped."""
    types = dict(df.dtypes)

    def field(name: str) -> Column:
        if types[name] in ("double", "float"):
            return nan_to_null(name).alias(name)
        return iso(name).alias(name) if types[name] == "timestamp" else F.col(name)

    body = F.to_json(F.struct(*map(field, columns)), {"ignoreNullFields": "false"})
    return df.select(F.col(key_col).alias("key"), body.alias("value"), *(carry or []))


def _kind_and_text(name: str) -> Column:
    """What one key of the parsed message holds. The kind is NULL for a missing key and
    VOID for a JSON null."""
    field = f"_fields['{name}']"
    return F.struct(
        F.schema_of_variant(F.expr(field)).alias("kind"), F.expr(f"try_cast({field} as string)").alias("text")
    ).alias(name)


def _typed(name: str, dtype: T.DataType) -> Column:
    """The value of a key, NULL when it does not cast to the column."""
    kind, text = F.col(f"_raw.{name}.kind"), F.col(f"_raw.{name}.text")
    nested = kind.startswith("OBJECT") | kind.startswith("ARRAY")
    if isinstance(dtype, T.DoubleType):
        value = F.when((kind != "BOOLEAN") & text.rlike(NUMBER_TEXT), text.try_cast("double"))
    elif isinstance(dtype, T.TimestampType):
        value = F.when((kind == "STRING") & text.rlike(STAMP_TEXT), text.try_cast("timestamp"))
    elif isinstance(dtype, T.BooleanType):
        value = F.when((kind == "BOOLEAN") | (kind == "STRING"), text.try_cast("boolean"))
    else:
        value = F.when(~nested, text)
    return F.when(kind != "VOID", value).alias(name)


def _once(df: DataFrame, keep: list[str], value: Column, name: str) -> DataFrame:
    """Add a column that is computed once per row.

    A plain projection would be merged into every filter and column that reads it. A
    one-element explode is a boundary the optimizer does not merge across.
    """
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def decode_messages(messages: DataFrame, contract: Contract) -> DataFrame:
    """Typed columns of each message, plus `is_valid`.

    A message is invalid when its value is not one JSON object, a declared key is missing
    (even a nullable one), a required column is null, or a field does not cast. Extra keys
    are ignored. The value is parsed inside an array because a JSON parser stops at the end
    of the first value and would not see what follows it; a second element shows it.
    """
    keep, fields = messages.columns, contract.schema.fields
    parsed = _once(messages, keep, F.expr("try_parse_json(concat('[', value, ']'))"), "_array")
    single = F.expr(
        """case when variant_get(_array, '$[1]', 'variant') is null
                then try_variant_get(_array, '$[0]', 'map<string, variant>') end"""
    )
    split = _once(parsed, keep, single, "_fields")
    raw = _once(split, keep, F.struct(*[_kind_and_text(f.name) for f in fields]), "_raw")
    typed = _once(
        raw.withColumn("_t", F.struct(*[_typed(f.name, f.dataType) for f in fields])),
        [*keep, "_raw"],
        F.col("_t"),
        "_typed",
    )

    def accepted(f: T.StructField) -> Column:
        has_value = F.col(f"_typed.{f.name}").isNotNull()
        return has_value | (F.col(f"_raw.{f.name}.kind") == "VOID") if f.nullable else has_value

    checks = reduce(lambda a, b: a & b, map(accepted, fields))
    return typed.select(*keep, "_typed.*", F.coalesce(checks, F.lit(False)).alias("is_valid"))


def split_valid(decoded: DataFrame, contract: Contract) -> tuple[DataFrame, DataFrame]:
    """(rows of the table, dead letters with the original key and value)."""
    extra = [c for c in ("partition", "offset") if c in decoded.columns]
    rows = decoded.filter("is_valid").select(*contract.schema.fieldNames(), *extra)
    dead = decoded.filter("not is_valid").select("key", "value", *extra)
    return rows, dead
