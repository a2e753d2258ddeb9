"""Training-data operators (archives, filters, dedup, search, mixing, scoring).

Nothing else in the library imports this subpackage. ``queries.QUERIES`` and
``queries.ORACLE_SQL`` are what the entry module registers.
"""
