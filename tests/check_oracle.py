"""Compare registered queries with their SQL twins: ``python tests/check_oracle.py DIR [names…]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as driver
from corpusmill.session import local_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]

    def cell(v):
        if v is None or v is pd.NA or (isinstance(v, float) and v != v):
            return "NULL"
        if isinstance(v, float):
            return repr(round(v, 9))
        return repr(v.item() if hasattr(v, "item") else v)

    return sorted(tuple(cell(v) for v in row) for row in pdf.astype(object).itertuples(index=False, name=None))


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    start = time.time()
    got = driver.queries()[name](spark, sf_dir).toPandas()
    took = time.time() - start
    sql = driver.oracle_sql().get(name)
    if sql is None:
        return True, f"{name}: {len(got)} rows, no SQL, {took:.2f}s"
    want = con.execute(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return False, f"{name}: columns {sorted(got.columns)} != {sorted(want.columns)}"
    a, b = canonical(got), canonical(want)
    types = [(c, str(got[c].dtype), str(want[c].dtype)) for c in got.columns if got[c].dtype.kind != want[c].dtype.kind]
    note = f" types differ {types}" if types else ""
    if a != b:
        only_a = [r for r in a if r not in set(b)][:2]
        only_b = [r for r in b if r not in set(a)][:2]
        return False, f"{name}: {len(a)} vs {len(b)} rows; spark {only_a} sql {only_b}"[:1500]
    return True, f"{name}: {len(got)} rows match, {took:.2f}s{note}"


if __name__ == "__main__":
    directory, wanted = sys.argv[1], sys.argv[2:]
    session = local_session(8)
    session.sparkContext.setLogLevel("ERROR")
    connection = connect(directory)
    failed = []
    for q in wanted or list(driver.queries()):
        try:
            ok, text = compare(session, connection, q, directory)
        except Exception as e:  # noqa: BLE001
            ok, text = False, f"{q}: {type(e).__name__} {str(e)[:1200]}"
        print("ok  " if ok else "FAIL", text, flush=True)
        if not ok:
            failed.append(q)
    print("failed:", failed)
