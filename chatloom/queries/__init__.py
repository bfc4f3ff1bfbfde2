"""All queries on the library's own operators, and their SQL."""

from __future__ import annotations

from chatloom.queries import conversations, duplicates, plans, reports

_ALL = conversations.QUERIES | duplicates.QUERIES | plans.QUERIES | reports.QUERIES

QUERIES = {name: query for name, (query, _) in _ALL.items()}
ORACLES = {name: sql for name, (_, sql) in _ALL.items() if sql}
