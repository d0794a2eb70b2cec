"""Training-data operators: filtering, deduplication, scans, scoring and tokenizing of whole document tables.

Nothing outside this subpackage imports it.  ``registry.QUERIES`` and
``registry.ORACLES`` hold its registered queries and their DuckDB twins.
"""
