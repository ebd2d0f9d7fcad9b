"""Compare registered queries with their DuckDB oracle: check.py [sf] [name or prefix ...]."""

import decimal
import math
import sys
import time

import duckdb

from tessella.fixtures import TABLES
from tessella.queries import load
from tessella.session import local_session


def norm(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, (bytearray, bytes)):
        return bytes(value).hex()
    if hasattr(value, "asDict"):
        return tuple(norm(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, norm(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(norm(v) for v in value)
    return value


def kinds(value):
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    return type(value).__name__


def rows_sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def main(argv):
    sf = argv[1] if len(argv) > 1 else "0.01"
    names = argv[2:]
    base = f"/root/testdata/sf{sf}"
    spark = local_session("check")
    queries, oracles = load()
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{base}/{t}.parquet'")
    bad = []
    for name, fn in queries.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            df = fn(spark, base)
            got_cols, got = rows_sorted(df.columns, df.collect())
        except Exception as exc:  # noqa: BLE001
            bad.append(name)
            print(f"FAIL {name}: {type(exc).__name__} {str(exc)[:1200]}")
            continue
        took = time.time() - start
        if name not in oracles:
            print(f"rows {name}: {len(got)} rows, {took:.1f}s")
            continue
        try:
            res = con.execute(oracles[name])
            want_cols, want = rows_sorted([d[0] for d in res.description], res.fetchall())
        except Exception as exc:  # noqa: BLE001
            bad.append(name)
            print(f"FAIL {name} oracle: {str(exc)[:800]}")
            continue
        types_got = [{kinds(v) for v in c if v is not None} for c in zip(*got)]
        types_want = [{kinds(v) for v in c if v is not None} for c in zip(*want)]
        if got_cols == want_cols and got == want and types_got == types_want:
            print(f"ok   {name}: {len(got)} rows, {took:.1f}s" + ("" if got else "   EMPTY"))
        else:
            bad.append(name)
            print(f"DIFF {name}: {len(got)} vs {len(want)} rows, {got_cols} vs {want_cols}")
            if types_got != types_want:
                print("   types", types_got, types_want)
            missing = [r for r in want if r not in set(got)][:3] if len(want) < 200000 else []
            extra = [r for r in got if r not in set(want)][:3] if len(got) < 200000 else []
            print("   want", missing, "\n   got ", extra)
    print("bad:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
