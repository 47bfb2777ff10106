"""Run registered queries beside their SQL in DuckDB and compare the rows."""

import datetime
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    """None when equal, else a text that tells the difference."""
    df = fn(spark, sf_dir)
    got_cols, got = rows_by_name(df.columns, df.collect())
    if sql is None:
        return None
    res = con.execute(sql)
    want_cols, want = rows_by_name([d[0] for d in res.description], res.fetchall())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if got != want:
        extra, lost = got - want, want - got
        return (f"rows {sum(got.values())} vs {sum(want.values())}; only Spark {sum(extra.values())} "
                f"{list(extra)[:2]}; only SQL {sum(lost.values())} {list(lost)[:2]}")
    return None


def main(sf_dir, names):
    from sluice.catalog import ORACLES, QUERIES
    from sluice.session import local_session

    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name in names or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, con, name, QUERIES[name], ORACLES.get(name), sf_dir)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
