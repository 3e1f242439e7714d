"""Run registered queries on Spark and their SQL twins on DuckDB and compare.

    python tests/oracle_check.py [--dir DIR] [name-prefix ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str):
    from sparkwell.tables import TABLE_NAMES

    con = duckdb.connect()
    for name in TABLE_NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def norm(value):
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0 if value != 0 else 0.0)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def spark_side(df):
    names = sorted(df.columns)
    types = dict(df.dtypes)
    rows = df.select(*[f"`{n}`" for n in names]).collect()
    return names, [types[n] for n in names], sorted(tuple(norm(v) for v in r) for r in rows)


def duck_side(con, sql):
    rel = con.execute(sql)
    cols = [(d[0], str(d[1])) for d in rel.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i][0])
    rows = sorted(tuple(norm(r[i]) for i in order) for r in rel.fetchall())
    return [cols[i][0] for i in order], [cols[i][1] for i in order], rows


def compare(df, con, sql) -> tuple[int, list[str]]:
    """(row count, problems)."""
    names, types, rows = spark_side(df)
    if sql is None:
        return len(rows), []
    onames, otypes, orows = duck_side(con, sql)
    bad = []
    if names != onames:
        bad.append(f"columns {names} vs {onames}")
    for n, a, b in zip(names, types, otypes):
        if TYPES.get(a, a) != b:
            bad.append(f"type of {n}: {a} vs {b}")
    if len(rows) != len(orows):
        bad.append(f"rows {len(rows)} vs {len(orows)}")
    if rows != orows:
        left, right = set(rows) - set(orows), set(orows) - set(rows)
        bad.append(f"values differ: spark-only {sorted(left)[:3]} oracle-only {sorted(right)[:3]}")
    return len(rows), bad


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from sparkwell.session import build_session

    sf_dir = "/root/testdata/sf0.01"
    if argv[:1] == ["--dir"]:
        sf_dir, argv = argv[1], argv[2:]
    conf = {"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    conf |= dict(pair.split("=", 1) for pair in os.environ.get("SPARK_CONF", "").split() if pair)
    spark = build_session(master="local[8]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sqls = entry.oracle_sql()
    failed = []
    picked = {n: f for n, f in entry.queries().items() if not argv or any(n.startswith(a) for a in argv)}
    for name, fn in picked.items():
        start = time.time()
        try:
            n, bad = compare(fn(spark, sf_dir), con, sqls.get(name))
        except Exception as e:  # noqa: BLE001
            n, bad = -1, [f"{type(e).__name__}: {str(e)[:700]}"]
            if os.environ.get("TRACE"):
                traceback.print_exc()
        note = "" if sqls.get(name) else " (rows only)"
        if n == 0:
            note += " EMPTY"
        print(f"{'FAIL' if bad else 'ok  '} {name} rows={n} {time.time() - start:.1f}s{note}", flush=True)
        for b in bad:
            print("     ", b[:900], flush=True)
        if bad:
            failed.append(name)
    print(f"{len(picked) - len(failed)}/{len(picked)} ok; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
