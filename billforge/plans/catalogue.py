"""All queries and SQL outside the subpackage llm."""

from __future__ import annotations

from billforge.plans import general, general_sql, reference, session  # noqa: F401  session registers with reference


def queries() -> dict:
    return {**general.QUERIES, **reference.QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**general_sql.SQL, **reference.SQL}
