"""Training-data operators: deduplication, quality, mixing, extraction, search, packing.

Nothing outside this subpackage imports it. Every operator takes and returns
DataFrames; ``registry`` binds them to the given tables as ``opN_<name>``.
"""
