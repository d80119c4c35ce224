"""Registered queries."""


def _load():
    from pagemill.plans import cleaning, limiting, searching, structure, web  # noqa: F401


def all_queries():
    _load()
    from pagemill.plans.registry import QUERIES

    return dict(QUERIES)


def all_sql():
    _load()
    from pagemill.plans.registry import SQL

    return dict(SQL)
