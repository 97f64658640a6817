"""Compare registered queries with their expected results: ``python -m conformance.check [sf_dir] [name …]``."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    return con


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) if not isinstance(v, list) else (False, "list", str(v)) for v in r))


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[bool, str]:
    got_rows = [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    wide = [c for c, t in types.items() if "HUGEINT" in t or "DECIMAL" in t or "DATE" in t or "TIMESTAMP" in t]
    want_rows = result.fetchall()
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} vs {sorted(columns)}"
    got, want = rows_of(df.columns, got_rows), rows_of(columns, want_rows)
    note = f" [wide types {wide}]" if wide else ""
    if len(got) != len(want):
        return False, f"rows {len(got)} vs {len(want)}{note}"
    kinds = {c: t for c, t in df.dtypes}
    clash = [
        f"{c}:{kinds[c]}/{types[c]}" for c in columns
        if {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}.get(kinds[c], types[c]) != types[c]
    ]
    if clash:
        note += f" [types {clash}]"
    for g, w in zip(got, want):
        if g != w:
            return False, f"{sorted(columns)}\n   got  {g}\n   want {w}{note}"
    return not note, f"{len(got)} rows{note}"


def main() -> None:
    from conformance import load_all
    from conformance.registry import EXPECTED, QUERIES
    from tradewind.session import local_session

    load_all()
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [n for n in QUERIES if not args or any(a in n for a in args)]
    spark, con = local_session(8), connect(sf_dir)
    failed = []
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in EXPECTED:
                ok, note = compare(df, con, EXPECTED[name])
            else:
                n = df.count()
                ok, note = n > 0, f"{n} rows, no expected result"
        except Exception as error:  # report and go on with the next query
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} {time.time() - start:6.2f}s  {note}", flush=True)
        if not ok:
            failed.append(name)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")


if __name__ == "__main__":
    main()
