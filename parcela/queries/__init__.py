"""One query for each of the engine's operators, with SQL that gives the same rows."""

from . import crawl, diagnostics, drain, glyphs, hourly, joins, layout, merge, nested, report, scalars, state  # noqa: F401
from .registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
