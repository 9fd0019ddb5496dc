"""DataFrame → DataFrame operators."""

from lakestream.operators.enrich import (drop_shared_columns, enrich, estimate_size, fits_broadcast,
                                         hot_keys, salted_join, split_hot_join)
from lakestream.operators.envelope import (decode_messages, encode_messages, field_types, parse_evolving, parse_json,
                                           to_envelope)
from lakestream.operators.quality import (clean_string_columns, coerce_numeric, dedup_rows,
                                          numeric_rows, quarantine_unparsed, require_not_null)
from lakestream.operators.stats import (distinct_values, group_means, indicator_columns,
                                        indicator_map, indicator_name, indicator_vectors, latest_per_key,
                                        preview, profile, row_count, value_dictionary, weighted_means)

__all__ = [
    "clean_string_columns", "coerce_numeric", "decode_messages", "dedup_rows", "distinct_values",
    "drop_shared_columns", "encode_messages", "enrich", "estimate_size", "field_types", "fits_broadcast",
    "group_means", "indicator_columns", "hot_keys", "indicator_map", "indicator_name", "indicator_vectors", "latest_per_key",
    "numeric_rows", "parse_evolving", "parse_json", "preview", "profile", "quarantine_unparsed", "require_not_null",
    "row_count", "salted_join", "split_hot_join", "to_envelope", "value_dictionary", "weighted_means",
]
