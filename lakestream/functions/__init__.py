"""Column expressions: every function returns a native ``Column``.

Nothing here runs Python per row; all expressions stay inside whole-stage
code generation.
"""

from lakestream.functions.envelope import (is_utf8, json_envelope, parse_json_column, parse_variant, parsed_once, utf8_bytes,
                                           utf8_text)
from lakestream.functions.numeric import as_double, is_numeric
from lakestream.functions.stamps import batch_tag, run_timestamp
from lakestream.functions.text import KEEP_PATTERN, clean_text

__all__ = [
    "KEEP_PATTERN", "as_double", "batch_tag", "clean_text", "is_numeric", "is_utf8", "json_envelope",
    "parse_json_column", "parse_variant", "parsed_once", "run_timestamp", "utf8_bytes", "utf8_text",
]
