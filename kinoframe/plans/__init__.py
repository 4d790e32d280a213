"""Queries by name, and the same rows as DuckDB SQL."""

from . import extensions, further, media, motion, publication, scale

_PARTS = (media, motion, extensions, publication, further, scale)
QUERIES = {name: query for part in _PARTS for name, query in part.QUERIES.items()}
ORACLE_SQL = {name: sql for part in _PARTS for name, sql in part.SQL.items()}
