"""Run registered queries against their SQL and report differences.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import sys
import tempfile
import time
from decimal import Decimal

import duckdb
import pandas as pd

from orderloom.session import clear_scratch, local_session

from . import ORACLES, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def normal(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, Decimal):
        return str(value)
    return value if isinstance(value, (str, bool)) else (float(value) if isinstance(value, float) else value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(normal(r[i]) for i in order) for r in rows]
    return [columns[i] for i in order], sorted(out, key=repr)


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, sf_dir: str, name: str) -> tuple[bool, str]:
    started = time.monotonic()
    df = QUERIES[name](spark, sf_dir)
    got = df.collect()
    seconds = time.monotonic() - started
    if name not in ORACLES:
        return True, f"{len(got)} rows, no SQL, {seconds:.1f}s"
    result = con.execute(ORACLES[name])
    types = {d[0]: str(d[1]) for d in result.description}
    want = result.fetchall()
    got_columns, got_rows = rows_of(df.columns, got)
    want_columns, want_rows = rows_of(list(types), want)
    if got_columns != want_columns:
        return False, f"columns {got_columns} != {want_columns}"
    if got_rows != want_rows:
        odd = next(((g, w) for g, w in zip(got_rows, want_rows) if g != w), None)
        return False, f"rows {len(got_rows)} != {len(want_rows)}; first difference {odd}"
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return True, f"{len(got)} rows, {seconds:.1f}s  " + " ".join(f"{c}:{kinds[c]}/{types[c]}" for c in got_columns)


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark, con, failed = local_session(tempfile.mkdtemp(prefix="orderloom-"), 8), database(sf_dir), []
    for name in names:
        try:
            ok, note = compare(spark, con, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:1500]}"
        print("ok  " if ok else "FAIL", name, note, flush=True)
        if not ok:
            failed.append(name)
    clear_scratch(spark)
    print(f"{len(names) - len(failed)} of {len(names)} agree; failed: {failed}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
