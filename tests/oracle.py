"""Side-by-side check of the registered queries against their SQL twins.

``python tests/oracle.py [name ...]`` prints one line per query; the test-suite uses ``compare``.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return float(f"{value:.12g}") + 0.0
    if isinstance(value, Decimal):
        return str(value)
    return value


def _rows(rows, order):
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, run, sql, folder):
    """A list of differences; empty when both sides agree."""
    df = run(spark, folder)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} <> {sorted(names)}"]
    order = sorted(range(len(names)), key=lambda i: names[i])
    order_s = sorted(range(len(df.columns)), key=lambda i: df.columns[i])
    a, b = _rows(got, order_s), _rows(want, order)
    notes = []
    if len(a) != len(b):
        notes.append(f"rows {len(a)} <> {len(b)}")
    types = {n: str(t[1]) for n, t in zip(names, cur.description)}
    for n, t in df.dtypes:
        if not _same_type(t, types[n]):
            notes.append(f"type {n}: {t} <> {types[n]}")
    if a != b:
        sa, sb = set(map(repr, a)), set(map(repr, b))
        notes.append(f"values: only spark {sorted(sa - sb)[:2]} only sql {sorted(sb - sa)[:2]}")
    return notes


def _same_type(spark_type: str, sql_type: str) -> bool:
    t = sql_type.lower()
    table = {"bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "boolean": "boolean",
             "date": "date", "timestamp_ntz": "timestamp", "float": "float"}
    if spark_type.startswith("decimal"):
        return t.startswith("decimal") and t.split(",")[-1] == spark_type.split(",")[-1]
    return table.get(spark_type, spark_type) == t


def main(argv):
    from bazaarline.session import get_session

    import __spark_entry__ as entry

    folder = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = get_session(master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("NO_BROADCAST"):
        # every lookup as on tables too large to broadcast, with keys of 200 rows already "hot"
        from bazaarline.operators import skew

        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        skew.HOT_ROWS = 200
    con = connect(folder)
    runs, sqls = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in sorted(runs):
        if argv and not any(a in name for a in argv):
            continue
        start = time.time()
        try:
            if name in sqls:
                notes = compare(spark, con, name, runs[name], sqls[name], folder)
            else:
                notes = [] if runs[name](spark, folder).count() > 0 else ["no rows"]
        except Exception as error:  # noqa: BLE001
            notes = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(notes)
        print(f"{'FAIL' if notes else 'ok  '} {name} {time.time() - start:.1f}s", *notes, flush=True)
    print(f"{bad} failed")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
