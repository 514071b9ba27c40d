"""Plan composition: the materialised warehouse, the query registry and
plan inspection helpers."""
