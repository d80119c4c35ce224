"""Named queries over the test tables, each with an equivalent SQL text where one exists."""

QUERIES = {}
SQL = {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            SQL[name] = sql
        return fn

    return add
