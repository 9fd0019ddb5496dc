"""Row-quality operators: numeric filters, coercion, cleaning, dedup, not-null."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lakestream.functions import as_double, clean_text, is_numeric
from lakestream.functions.text import NULL_TEXT


def numeric_rows(df: DataFrame, cols: Iterable[str], finite_only: bool = False) -> DataFrame:
    """Keep rows whose listed columns all convert to a double.

    The columns keep their original type and value; the test is inline, so no
    helper columns are added or dropped.
    """
    conds = [is_numeric(df[c], finite_only) for c in cols]
    return df.filter(reduce(lambda a, b: a & b, conds)) if conds else df


def coerce_numeric(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Replace each listed column by its double value; bad text becomes NULL."""
    return df.withColumns({c: as_double(df[c]) for c in cols})


def clean_string_columns(df: DataFrame, exclude: Iterable[str] = (),
                         null_text: str | None = NULL_TEXT) -> DataFrame:
    """Apply the text cleaner to every string column in one projection.

    Non-string columns and the ``exclude`` list pass through unchanged.
    """
    skip = set(exclude)
    out = []
    for field in df.schema.fields:
        c = df[field.name]
        if isinstance(field.dataType, StringType) and field.name not in skip:
            out.append(clean_text(c, null_text).alias(field.name))
        else:
            out.append(c)
    return df.select(out)


def dedup_rows(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Drop duplicate rows (NULLs compare equal); all columns by default.

    Planned as a hash aggregate with a map-side partial step, so a value that
    repeats very often is collapsed inside each map task before the shuffle.
    """
    return df.dropDuplicates(list(subset) if subset is not None else None)


def require_not_null(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep rows where every listed column is not NULL (NaN is kept)."""
    conds = [df[c].isNotNull() for c in cols]
    return df.filter(reduce(lambda a, b: a & b, conds)) if conds else df


def quarantine_unparsed(df: DataFrame, struct_col: str) -> tuple[DataFrame, DataFrame]:
    """Split rows whose parsed struct is entirely NULL from the good rows."""
    fields = df.schema[struct_col].dataType.fieldNames()
    all_null = reduce(lambda a, b: a & b,
                      [F.col(f"`{struct_col}`.`{f}`").isNull() for f in fields])
    return df.filter(~all_null), df.filter(all_null)
