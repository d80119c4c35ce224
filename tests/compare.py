"""Runs registered queries on Spark and their SQL on DuckDB and compares all rows."""

import datetime
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(folder):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if hasattr(value, "as_integer_ratio") and not isinstance(value, (int, bool)):
        return round(float(value), 6)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, folder):
    """Returns (row count, None) or (row count, description of the difference)."""
    df = fn(spark, folder)
    got_cols, got = rows_of(df.columns, df.collect())
    n = sum(got.values())
    if sql is None:
        return n, None
    cur = con.execute(sql)
    want_cols, want = rows_of([c[0] for c in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return n, f"columns {got_cols} != {want_cols}"
    if got != want:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return n, f"{sum((got - want).values())} extra, {sum((want - got).values())} missing\n  spark {extra}\n  sql   {missing}"
    return n, None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from pagemill.session import get_session

    folder = sys.argv[1]
    names = sys.argv[2:]
    spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                       "spark.driver.memory": "10g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    queries, sqls = entry.queries(), entry.oracle_sql()
    for name, fn in queries.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            n, problem = compare(spark, con, name, fn, sqls.get(name), folder)
        except Exception as error:  # report and go on with the next query
            n, problem = -1, f"{type(error).__name__}: {str(error)[:700]}"
        status = "BAD " if problem or n == 0 else "ok  " if name in sqls else "rows"
        print(status, name, n, f"{time.time() - start:.1f}s", (problem or "")[:1500], flush=True)
