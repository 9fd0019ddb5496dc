"""Text cleaning as a native regular-expression replacement."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakestream.functions._util import to_col

# ---------------------------------------------------------------------------
# Fixed values (must equal the original cleaner for identical results):
# every character that is NOT one of the following is deleted:
#   ASCII letters a-z and A-Z, digits 0-9, comma, period, backslash,
#   double quote, single quote.
# A NULL input is first turned into the text "None".
# ---------------------------------------------------------------------------
KEEP_PATTERN = r"""[^a-zA-Z0-9,.\\"']"""
NULL_TEXT = "None"


def clean_text(c: Column | str, null_text: str | None = NULL_TEXT) -> Column:
    """Delete every character outside the kept set.

    ``null_text`` replaces NULL before cleaning (the original behaviour turns
    NULL into ``"None"``); pass ``None`` to keep NULL as NULL.
    """
    src = to_col(c)
    if null_text is not None:
        src = F.coalesce(src, F.lit(null_text))
    return F.regexp_replace(src, KEEP_PATTERN, "")
