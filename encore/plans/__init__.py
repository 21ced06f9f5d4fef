"""Registered queries (``queries.py``) and their DuckDB oracle SQL (``oracle_sql.py``)."""
