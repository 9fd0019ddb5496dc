"""JSON message envelopes and UTF-8 payload conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestream.functions._util import to_col


# Spark's default JSON text keeps only milliseconds of a timestamp; these
# formats keep all six fractional digits, so a message round-trips exactly.
TIMESTAMP_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def json_envelope(*cols: Column | str, keep_nulls: bool = False,
                  options: dict[str, str] | None = None) -> Column:
    """All given columns as one JSON object text.

    Spark drops NULL fields by default; ``keep_nulls=True`` writes them as
    ``null``. Timestamps are written with microseconds (ISO-8601).
    """
    opts = dict(TIMESTAMP_OPTIONS)
    if keep_nulls:
        opts["ignoreNullFields"] = "false"
    opts.update(options or {})
    return F.to_json(F.struct(*[to_col(c) for c in cols]), opts)


def parse_json_column(c: Column | str, schema: StructType | str) -> Column:
    """Parse JSON text (or UTF-8 bytes) into a struct of the fixed schema.

    Malformed text gives a struct of NULLs; a field of the wrong type gives
    a NULL field.
    """
    return F.from_json(to_col(c).cast("string"), schema)


def parsed_once(c: Column | str, schema: StructType | str) -> Column:
    """:func:`parse_json_column` as a generator of one row, for a ``select``.

    Conditions on fields, and those that Spark infers from joins, stay above a
    generator. Above a plain column they are pushed below it, with the text
    parsed anew for each field that they name.
    """
    return F.explode_outer(F.array(parse_json_column(c, schema)))


def utf8_text(c: Column | str) -> Column:
    """Bytes decoded as UTF-8 text (NULL stays NULL); broken sequences become U+FFFD instead of failing the job."""
    return F.make_valid_utf8(to_col(c).cast("string"))


def is_utf8(c: Column | str) -> Column:
    """Whether bytes are valid UTF-8 (NULL stays NULL): the flag by which broken messages are set apart."""
    return F.is_valid_utf8(to_col(c).cast("string"))


def utf8_bytes(c: Column | str) -> Column:
    """Text encoded as UTF-8 bytes (NULL stays NULL)."""
    return F.encode(to_col(c), "UTF-8")


def parse_variant(c: Column | str) -> Column:
    """JSON text (or UTF-8 bytes) as a VARIANT; NULL for text that isn't JSON or has a field twice."""
    return F.try_parse_json(to_col(c).cast("string"))
