"""Run registered queries against their SQL in DuckDB.

    python -m tests.oracle_check [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import sys
import time
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def _cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return f"{value:.9g}" if value else "0"
    return str(value)


def rows_of(names: list[str], rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(_cell(r[i]) for i in order) for r in rows)


KINDS = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def compare(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    want_cols, want = rows_of(names, result.fetchall())
    got_cols, got = rows_of(df.columns, df.collect())
    if want_cols != got_cols:
        return f"columns {got_cols} != {want_cols}"
    wrong = [
        (c, t, kinds[c]) for c, t in df.dtypes if KINDS.get(t, t) != kinds[c]
        and not (kinds[c] == "NUMBER" and t in ("bigint", "double", "int"))
        and kinds[c] not in ("STRING", "Date", "DATETIME", "bool", "NULL")
    ]
    if want != got:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return (f"rows {sum(got.values())} vs {sum(want.values())}\n  cols  {got_cols}"
                f"\n  spark {extra}\n  sql   {missing}")
    return f"types {wrong}" if wrong else None


def main() -> int:
    import __spark_entry__ as entry

    from tallychain.session import local_session

    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.001")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args()
    spark = local_session()
    con = connect(args.sf)
    plans, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or plans:
        start = time.time()
        try:
            df = plans[name](spark, args.sf)
            if name in sql:
                problem = compare(df, con, sql[name])
                n = ""
            else:
                n, problem = f"{df.count()} rows, no SQL", None
        except Exception as exc:  # report and go on
            problem = f"{type(exc).__name__}: {str(exc)[:700]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {problem or n}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
