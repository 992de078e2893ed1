"""Run registered queries beside their SQL and report differences."""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

from factorloom.session import build_session
from suite import ORACLES, QUERIES


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, Decimal):
        return f"{v:f}"
    if hasattr(v, "tzinfo") and v.tzinfo is not None:
        v = v.replace(tzinfo=None)
    return repr(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(_cell(r[i]) for i in order) for r in rows)


SPARK_TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
               "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
               "timestamp": "TIMESTAMP", "float": "FLOAT"}


def check(spark, con, sf_dir: str, name: str) -> tuple[str, str]:
    df = QUERIES[name](spark, sf_dir)
    got = [tuple(x) for x in df.collect()]
    cols, got_rows = rows_of(df.columns, got)
    if name not in ORACLES:
        return "rows", f"{len(got_rows)} rows"
    cur = con.execute(ORACLES[name])
    want_types = {c[0]: str(c[1]) for c in cur.description}
    want_cols, want_rows = rows_of([c[0] for c in cur.description], cur.fetchall())
    if cols != want_cols:
        return "FAIL", f"columns {cols} != {want_cols}"
    types = {c: SPARK_TYPES.get(t, t.upper().replace(" ", "")) for c, t in df.dtypes}
    odd = {c: (types[c], want_types[c]) for c in cols
           if types[c] != want_types[c].replace(" ", "")}
    if got_rows != want_rows:
        extra = [x for x in got_rows if x not in set(want_rows)][:2]
        lack = [x for x in want_rows if x not in set(got_rows)][:2]
        counts = f"{len(got_rows)} vs {len(want_rows)} rows"
        return "FAIL", f"{counts}\n  {cols}\n  got {extra}\n  want {lack}"
    return ("types" if odd else "ok"), f"{len(got_rows)} rows {odd or ''}"


def main(argv: list[str]) -> int:
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    names = [n for n in QUERIES if not argv or any(n == a or (
        a.endswith("*") and n.startswith(a[:-1])) for a in argv)]
    bad = 0
    for name in names:
        begin = time.time()
        try:
            verdict, note = check(spark, con, sf_dir, name)
        except Exception as e:  # report and go on with the next query
            verdict, note = "ERROR", f"{type(e).__name__}: {str(e)[:1500]}"
        bad += verdict in ("FAIL", "ERROR")
        if verdict != "ok" or note.startswith("0 rows") or len(names) < 40:
            print(f"{verdict:6} {name:28} {time.time() - begin:5.1f}s {note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} good")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
