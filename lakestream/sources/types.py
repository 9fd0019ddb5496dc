"""Column types of text tables, found while they are written.

Reading delimited text with inferred types takes a pass of its own. Here the
text is written as it is, and the same pass observes of every column which types
all of its values fit. A value's types are bits, so those of many values are the
bitwise *and* of theirs: it doesn't matter in which order, or how often, tasks
add a value. The bits are kept beside the data and the columns are cast when the
table is read (:func:`lakestream.sources.read_layer`); of a table that was
appended to, those of all its writes are and-ed, so a later write widens a type.

A column gets the first type of ``TYPES`` that all its values fit: ``int``, else
``bigint``, ``decimal(38,0)``, ``double``, ``date``, ``timestamp``, ``boolean``;
else, and if it has no value, it stays text. Whole numbers and decimals are
written with digits (``.5``, ``1e9``, ``NaN`` and ``Inf`` included); dates are
``2024-01-31``; timestamps have ``T`` or a blank before the time, up to six
fractional digits and perhaps a zone (without one the reading session's zone
holds). Blanks around a value make it text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakestream.sources.versions import get_text, put_text

#: Narrowest first; a type's bit is its place.
TYPES = ("int", "bigint", "decimal(38,0)", "double", "date", "timestamp", "boolean")
_FILE = "_types.json"
_WHOLE = r"^[+-]?[0-9]++$"
_NUMBER = r"^[+-]?(?:[0-9]++[.]?[0-9]*+|[.][0-9]++)(?:[eE][+-]?[0-9]++)?$"
_WORD = r"^NaN$|^[+-]?Inf(inity)?$"
_D = "[0-9]"
_DATE = f"^{_D * 4}-{_D * 2}-{_D * 2}$"
_TIMESTAMP = f"^{_D * 4}-{_D * 2}-{_D * 2}[T ]{_D * 2}:{_D * 2}:{_D * 2}(?:[.][0-9]{{1,6}}+)?(?:Z|[+-]{_D * 2}:{_D * 2})?$"


def _bits(*names: str) -> F.Column:
    return F.lit(sum(1 << TYPES.index(n) for n in names))


def fitting_types(value: F.Column) -> F.Column:
    """The bits of the types that a text fits; NULL for NULL.

    Lengths and a few bytes tell first which patterns and casts are worth a try
    (a failing cast costs an exception), so a value takes one or two of them.
    """
    size, fits = F.octet_length(value), lambda name: value.try_cast(name).isNotNull()
    signed = (value >= "+") & (value < ":")  # begins with a digit, a sign or one of , . /
    days = (F.substring(value, 5, 1) == "-") & (F.substring(value, 8, 1) == "-")  # no number has both
    long = value.try_cast("bigint")
    wide = _bits("int", "bigint", "decimal(38,0)", "double")
    # the patterns' $ allows a line end of up to three bytes
    words = (F.when((size < 3) | (size > 12), F.lit(0))
             .when(value.rlike(_WORD), _bits("double"))
             .when(F.lower(value).isin("true", "false"), _bits("boolean"))
             .otherwise(F.lit(0)))
    dated = (F.when((size < 14) & value.rlike(_DATE) & fits("date"), _bits("date", "timestamp"))
             .when((size > 14) & value.rlike(_TIMESTAMP) & fits("timestamp"), _bits("timestamp"))
             .otherwise(F.lit(0)))
    whole = (F.when((size < 10) & fits("int"), wide)
             .when(long.between(-(1 << 31), (1 << 31) - 1), wide)
             .when(long.isNotNull(), _bits("bigint", "decimal(38,0)", "double"))
             .when(fits("decimal(38,0)"), _bits("decimal(38,0)", "double"))
             .otherwise(_bits("double")))
    return (F.when(value.isNull(), F.lit(None).cast("int"))
            .when(~signed, words)
            .when(days, dated)
            .when(~F.contains(value, F.lit(".")) & value.rlike(_WHOLE), whole)
            .when(value.rlike(_NUMBER), _bits("double"))
            .when(value.rlike(_WORD), _bits("double"))
            .otherwise(F.lit(0)))


def type_of(bits: int | None) -> str:
    """The narrowest type of ``bits``; text if there is none."""
    return next((t for i, t in enumerate(TYPES) if bits and bits >> i & 1), "string")


def observe_types(df: DataFrame) -> tuple[DataFrame, Callable[[], dict[str, int | None]]]:
    """``df`` with its text columns observed, and a function that gives their bits once a write of it has ended."""
    names = [n for n, t in df.dtypes if t == "string"]
    if not names:
        return df, dict
    seen, bits = Observation(), "bits"
    while bits in {c.lower() for c in df.columns}:
        bits += "_"
    # found once a value, by one expression for all columns: bit_and would find a column's twice for each row,
    # and code made for each column grows beyond what the JVM compiles
    texts = F.array(*[df[f"`{n}`"] for n in names])
    observed = df.withColumn(bits, F.transform(texts, fitting_types)).observe(
        seen, *[F.bit_and(F.get(bits, F.lit(i))).alias(f"c{i}") for i in range(len(names))])
    return observed.drop(bits), lambda: {n: seen.get[f"c{i}"] for i, n in enumerate(names)}


def put_types(spark: SparkSession, folder: str, bits: dict[str, int | None]) -> None:
    put_text(spark, f"{folder}/{_FILE}", json.dumps(bits))


def known_types(spark: SparkSession, folders: Iterable[str]) -> dict[str, str]:
    """The types of columns that all the folders have observed as text or not seen a value of."""
    files = [get_text(spark, f"{f}/{_FILE}") for f in folders]
    if not files or None in files:
        return {}
    found = [json.loads(f) for f in files]
    shared = [n for n in found[0] if all(n in f for f in found)]
    bits = {n: [f[n] for f in found if f[n] is not None] for n in shared}
    return {n: type_of(reduce(int.__and__, b) if b else None) for n, b in bits.items()}


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """``df`` with its text columns cast; the others as they are."""
    return df.select([df[f"`{n}`"].cast(types[n]).alias(n) if t == "string" and types.get(n, "string") != "string"
                      else df[f"`{n}`"] for n, t in df.dtypes]) if types else df
