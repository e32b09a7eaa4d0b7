"""Training-data operators: dedup, joins, tokenising, extraction, filters, sharding.

One module per operator; ``queries.py`` registers them, ``oracle.py`` has their
DuckDB SQL. Nothing outside this subpackage imports it.
"""
