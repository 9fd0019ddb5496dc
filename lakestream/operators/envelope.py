"""Row ↔ message operators: JSON envelopes, parsing, decoding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestream.functions import json_envelope, parse_variant, parsed_once, utf8_text


def to_envelope(df: DataFrame, keep_nulls: bool = False, key: str | None = None) -> DataFrame:
    """One ``value`` column holding each row as JSON text.

    With ``key`` the named column becomes the message ``key`` (as text).
    """
    value = json_envelope(*[df[c] for c in df.columns], keep_nulls=keep_nulls).alias("value")
    if key is None:
        return df.select(value)
    return df.select(df[key].cast("string").alias("key"), value)


def parse_json(df: DataFrame, schema: StructType, value_col: str = "value",
               keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse the JSON ``value`` column into one column per schema field.

    ``keep`` lists envelope columns (e.g. ``key``) to carry along.
    """
    parsed = parsed_once(df[value_col], schema).alias("data")
    return df.select(*[df[k] for k in keep], parsed).select(*keep, "data.*")


def decode_messages(df: DataFrame, schema: StructType | None = None) -> DataFrame:
    """Topic messages as text: ``key`` UTF-8 or NULL, ``value`` UTF-8 JSON.

    With a schema the value is parsed into typed columns as well.
    """
    decoded = df.select(utf8_text(df["key"]).alias("key"), utf8_text(df["value"]).alias("value"))
    if schema is None:
        return decoded
    return parse_json(decoded, schema, keep=("key",))


def encode_messages(df: DataFrame) -> DataFrame:
    """``key``/``value`` text columns as UTF-8 bytes, like a topic stores them."""
    key = F.encode(df["key"], "UTF-8") if "key" in df.columns else F.lit(None).cast("binary")
    return df.select(key.alias("key"), F.encode(df["value"], "UTF-8").alias("value"))


def _fields(message: Column | str) -> Column:
    """The fields of a VARIANT object by name; NULL for what is no object."""
    return F.try_variant_get(message, "$", "map<string,variant>")


def parse_evolving(df: DataFrame, fields: Mapping[str, str], value_col: str = "value",
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Messages of a topic whose payload changes: typed columns, and nothing of the rest is lost.

    ``fields`` gives names and Spark types. ``unknown`` holds the other fields of
    the message and ``misfits`` those named in ``fields`` whose value isn't of the
    type (their column is NULL), each as a JSON object, or NULL if there is none.
    ``broken`` is the text of a message that is no JSON object, else NULL. A
    field that is missing or null gives NULL and is no misfit.
    """
    clash = {*fields} & {"unknown", "misfits", "broken", *keep}
    if clash:
        raise ValueError(f"payload fields with names of other output columns: {sorted(clash)}")
    known = F.array(*[F.lit(n) for n in fields]) if fields else F.array().cast("array<string>")
    read = df.select(*[df[k] for k in keep], utf8_text(df[value_col]).alias("__text"),
                     _fields(parse_variant(df[value_col])).alias("__fields"))
    # by the map's key, not by a path: field names may hold dots and quotes
    typed = {n: F.try_variant_get(F.try_element_at("__fields", F.lit(n)), "$", t) for n, t in fields.items()}
    fits = F.array(*[F.when(c.isNotNull(), F.lit(n)) for n, c in typed.items()]) if fields else known
    unknown = F.map_filter("__fields", lambda k, v: ~F.array_contains(known, k))
    misfits = F.map_filter("__fields", lambda k, v: F.array_contains(known, k) & ~F.array_contains(F.array_compact(fits), k)
                           & ~F.is_variant_null(v))
    return read.select(*[F.col(k) for k in keep], *[c.alias(n) for n, c in typed.items()],
                       *[F.when(F.size(c) > 0, F.to_json(c, {"ignoreNullFields": "false"})).alias(n)
                         for n, c in (("unknown", unknown), ("misfits", misfits))],
                       F.when(F.col("__fields").isNull(), F.col("__text")).alias("broken"))


def field_types(df: DataFrame, value_col: str = "value", by: tuple[str, ...] = ()) -> DataFrame:
    """What a changing payload holds: ``field``, ``type`` and the ``messages`` with that field in that type.

    One row for each pair (and each value of the ``by`` columns); types are the
    VARIANT's own (``BIGINT``, ``STRING``, ``OBJECT<...>``). Counted map-side
    first, so the shuffle carries a row per field and type of a task.
    """
    read = df.select(*[df[c] for c in by], F.explode(_fields(parse_variant(df[value_col]))).alias("field", "__v"))
    return (read.groupBy(*by, "field", F.schema_of_variant("__v").alias("type"))
            .agg(F.count("*").alias("messages")))
