"""Run queries against their SQL: ``python tests/compare.py [-d sf_dir] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return value + 0.0
    return value


def as_rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(cell(r[i]) for i in order) for r in rows)


# Type pairs that stand for the same values in both engines.
KINDS = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
         "boolean": "BOOLEAN", "float": "FLOAT"}


def difference(df, con, sql: str) -> str:
    """Empty when rows, names and types agree."""
    want = con.execute(sql)
    want_cols = [d[0] for d in want.description]
    want_types = {d[0]: str(d[1]) for d in want.description}
    want_rows = want.fetchall()
    got_rows = [tuple(r) for r in df.collect()]
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    off = [(c, kinds[c], want_types[c]) for c in df.columns if KINDS.get(kinds[c]) != want_types[c]]
    a, b = as_rows(df.columns, got_rows), as_rows(want_cols, want_rows)
    if a != b:
        return (f"rows {sum(a.values())} vs {sum(b.values())}; columns {sorted(want_cols)}\n"
                f"   only spark: {list((a - b).items())[:4]}\n   only sql:   {list((b - a).items())[:4]}")
    return f"types {off}" if off else ""


def main() -> None:
    from tidemark.plans.bindings import ORACLES, QUERIES
    from tidemark.session import build_session

    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args[:1] == ["-d"]:
        sf_dir, args = args[1], args[2:]
    names = [n for n in QUERIES if not args or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in args)]
    spark = build_session("compare", 8, 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        at = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            message = difference(df, con, ORACLES[name]) if name in ORACLES else f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            message = f"ERROR {type(error).__name__}: {str(error)[:1500]}"
        fine = not message or message.startswith("no SQL")
        bad += not fine
        print(f"{'ok ' if fine else 'BAD'} {name} {time.time() - at:.1f}s {message}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")


if __name__ == "__main__":
    main()
