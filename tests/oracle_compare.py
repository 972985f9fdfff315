"""Compare ``queries()`` against ``oracle_sql()`` on one test-data folder.

Checks per query: row count, column names, Arrow types and the multiset of
rows (exact values, order-insensitive). Usable from pytest and as a script:

    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import json
import math
import os
import sys
import time

import duckdb
import pyarrow as pa

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm_type(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return f"timestamp(tz={t.tz})"
    return str(t)


def _key(v):
    if v is None:
        return (0, "")
    if isinstance(v, float) and math.isnan(v):
        return (2, "nan")
    return (1, repr(v))


def _rows(table: pa.Table) -> list[tuple]:
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    rows = list(zip(*data)) if data else []
    return sorted(rows, key=lambda r: tuple(_key(v) for v in r))


def compare(spark, sf_dir: str, names: list[str] | None = None) -> dict[str, dict]:
    import __spark_entry__ as entry

    qs, sql = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    report = {}
    for name in names or list(qs):
        rec: dict = {}
        t0 = time.time()
        got = qs[name](spark, sf_dir).toArrow()
        rec["spark_sec"] = round(time.time() - t0, 3)
        rec["rows"] = got.num_rows
        if name not in sql:
            rec["oracle"] = "none"
            report[name] = rec
            continue
        want = con.sql(sql[name]).to_arrow_table()
        rec["oracle_rows"] = want.num_rows
        rec["names_match"] = sorted(got.column_names) == sorted(want.column_names)
        gt = {f.name: _norm_type(f.type) for f in got.schema}
        wt = {f.name: _norm_type(f.type) for f in want.schema}
        rec["type_diffs"] = {k: (gt.get(k), wt.get(k)) for k in set(gt) | set(wt) if gt.get(k) != wt.get(k)}
        if rec["names_match"]:
            a, b = _rows(got), _rows(want)
            diffs = [i for i, (x, y) in enumerate(zip(a, b)) if x != y]
            rec["value_diffs"] = len(diffs) + abs(len(a) - len(b))
            if diffs:
                rec["first_diff"] = [str(a[diffs[0]]), str(b[diffs[0]])]
        rec["ok"] = (
            rec["rows"] == rec["oracle_rows"]
            and rec["names_match"]
            and not rec["type_diffs"]
            and rec.get("value_diffs") == 0
        )
        report[name] = rec
    return report


if __name__ == "__main__":
    from emporia.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:] or None
    spark = build_session("local[8]", shuffle_partitions=8)
    out = compare(spark, sf, only)
    for k, v in out.items():
        print(k, json.dumps(v, default=str))
    bad = [k for k, v in out.items() if v.get("oracle") != "none" and not v.get("ok")]
    print("FAILED:" if bad else "ALL OK", bad)
