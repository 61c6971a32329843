"""Run registered queries next to their SQL in DuckDB and compare exactly.

    python tests/oracle_check.py [--sf DIR] [key ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    return repr(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    got = df.toArrow()
    want = con.sql(sql).to_arrow_table()
    a = {f.name: str(f.type).replace("large_", "") for f in got.schema}
    b = {f.name: str(f.type).replace("large_", "") for f in want.schema}
    if a != b:
        return f"schema differs: { {k: (a.get(k), b.get(k)) for k in {*a, *b} if a.get(k) != b.get(k)} }"
    names = list(a)
    x = _rows(names, [tuple(r[n] for n in names) for r in got.to_pylist()])
    y = _rows(names, [tuple(r[n] for n in names) for r in want.to_pylist()])
    if len(x) != len(y):
        return f"{len(x)} rows, want {len(y)}"
    bad = [(p, q) for p, q in zip(x, y) if p != q]
    if bad:
        return f"{len(bad)} of {len(x)} rows differ, e.g. {sorted(names)}\n    got  {bad[0][0]}\n    want {bad[0][1]}"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from creditspark.session import local_session

    sf = "/root/testdata/sf0.01"
    if argv[:1] == ["--sf"]:
        sf, argv = argv[1], argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    queries, oracles = entry.queries(), entry.oracle_sql()
    keys = argv or list(queries)
    failed = []
    for key in keys:
        start = time.time()
        try:
            df = queries[key](spark, sf)
            if key in oracles:
                diff = compare(df, con, oracles[key])
                note = f"{df.count()} rows" if not diff and argv else ""
            else:
                diff, note = None, f"no SQL, {df.count()} rows"
        except Exception as exc:  # noqa: BLE001
            diff, note = f"{type(exc).__name__}: {str(exc)[:1500]}", ""
        print(f"{'FAIL' if diff else 'ok  '} {key} {time.time() - start:.2f}s {note} {diff or ''}", flush=True)
        if diff:
            failed.append(key)
    print(f"{len(keys) - len(failed)} of {len(keys)} agree; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
