"""Registry of the queries and their oracle SQL (used by ``__spark_entry__``)."""

from __future__ import annotations

from agora.plans.analogs import QUERIES
from agora.plans.oracle import ORACLE


def queries():
    return dict(QUERIES)


def oracle_sql():
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
