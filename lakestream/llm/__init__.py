"""Training-data operators: tokens, packing, filtering, deduplication, decontamination.

Nothing else in the library imports this subpackage. Each operator has its own
module; ``queries`` holds the registered queries and their SQL.
"""
