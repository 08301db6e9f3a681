"""All queries over the driver's tables, with the SQL that gives the same rows."""

from . import q_aggregates, q_books, q_dedup, q_joins, q_layout, q_rules, q_structure, q_text, q_trees, q_windows  # noqa: F401
from .registry import ORACLE_SQL, QUERIES  # noqa: F401
