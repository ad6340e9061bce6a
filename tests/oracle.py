"""Compare registered queries with their SQL twins.

``python -m tests.oracle [--sf 0.01] [name …]`` prints one line per query.
"""

from __future__ import annotations

import argparse
import sys
import time
import traceback

import duckdb

from __spark_entry__ import oracle_sql, queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if hasattr(value, "asDict"):
        return tuple(sorted((k, _plain(v)) for k, v in value.asDict().items()))
    if isinstance(value, float):
        return repr(value + 0.0)
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return repr(value)


def _kind(spark_type: str) -> str:
    return {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN"}.get(
        spark_type, spark_type
    )


def difference(spark, con, name: str, sf_dir: str) -> tuple[str, int]:
    """Empty text if both sides agree, else what differs; and the number of rows."""
    df = queries()[name](spark, sf_dir)
    cols = sorted(df.columns)
    got = [tuple(_plain(r[c]) for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect()]
    sql = oracle_sql().get(name)
    if sql is None:
        return ("" if got else "no rows"), len(got)
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    types = {c[0]: str(c[1]) for c in res.description}
    if sorted(names) != cols:
        return f"columns {cols} / {sorted(names)}", len(got)
    wrong = {c: (t, types[c]) for c, t in df.dtypes if _kind(t) != types[c]}
    order = [names.index(c) for c in cols]
    want = [tuple(_plain(r[i]) for i in order) for r in res.fetchall()]
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}", len(got)
    got.sort()
    want.sort()
    for g, w in zip(got, want):
        if g != w:
            pairs = [(c, a[:300], b[:300]) for c, a, b in zip(cols, g, w) if a != b]
            return f"values {pairs}", len(got)
    return (f"types {wrong}" if wrong else ""), len(got)


def main() -> int:
    from reportloom.session import build_session

    args = argparse.ArgumentParser()
    args.add_argument("names", nargs="*")
    args.add_argument("--sf", default="0.01")
    options = args.parse_args()
    sf_dir = f"/root/testdata/sf{options.sf}"
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in options.names or queries():
        start = time.time()
        try:
            text, rows = difference(spark, con, name, sf_dir)
        except Exception as error:
            text, rows = "".join(traceback.format_exception_only(error))[:1500], -1
        bad += bool(text)
        print(f"{'FAIL' if text else 'ok  '} {name:28} {rows:>8} rows {time.time() - start:6.1f}s {text}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
