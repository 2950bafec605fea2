"""Run a Spark query and its DuckDB oracle on the same parquet tables and compare.

Compares row counts, column names, column types and the multiset of rows
(columns sorted by name).  Used by tests and by ``python -m oracle.compare``.
"""

from __future__ import annotations

import collections
import datetime as dt
import decimal
import sys
import time

RAW = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
       "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str):
    import duckdb
    import os

    con = duckdb.connect()
    for t in RAW:
        p = f"{sf_dir.rstrip('/')}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def spark_type(duck_type: str) -> str:
    """Spark ``simpleString`` of a DuckDB column type."""
    t = duck_type.lower()
    return {"varchar": "string", "integer": "int"}.get(t, t)


def _norm(v):
    if isinstance(v, float):
        return ("f", repr(v))
    if isinstance(v, decimal.Decimal):
        return ("d", str(v))
    if isinstance(v, dt.datetime):
        return ("ts", v.isoformat())
    if isinstance(v, dt.date):
        return ("date", v.isoformat())
    return (type(v).__name__, v)


def compare(spark, con, df, sql: str, show: int = 5) -> dict:
    t0 = time.time()
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_types = [str(c[1]) for c in cur.description]
    d_rows = cur.fetchall()
    t2 = time.time()
    s_cols = df.columns
    s_types = [f.dataType.simpleString() for f in df.schema.fields]
    res = {"spark_rows": len(s_rows), "oracle_rows": len(d_rows), "spark_sec": round(t1 - t0, 2),
           "oracle_sec": round(t2 - t1, 2)}
    res["names_match"] = sorted(s_cols) == sorted(d_cols)
    if not res["names_match"]:
        res["spark_cols"], res["oracle_cols"] = s_cols, d_cols
        res["ok"] = False
        return res
    s_idx = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_idx = sorted(range(len(d_cols)), key=lambda i: d_cols[i])
    res["types"] = [(s_cols[i], s_types[i], d_types[j]) for i, j in zip(s_idx, d_idx)]
    s_ms = collections.Counter(tuple(_norm(r[i]) for i in s_idx) for r in s_rows)
    d_ms = collections.Counter(tuple(_norm(r[j]) for j in d_idx) for r in d_rows)
    res["values_match"] = s_ms == d_ms
    res["types_match"] = all(st == spark_type(dtp) for _, st, dtp in res["types"])
    res["ok"] = res["values_match"] and res["types_match"] and len(s_rows) == len(d_rows)
    if not res["values_match"]:
        only_s = list((s_ms - d_ms).elements())[:show]
        only_d = list((d_ms - s_ms).elements())[:show]
        res["cols"] = [s_cols[i] for i in s_idx]
        res["only_spark"], res["only_oracle"] = only_s, only_d
        res["n_only_spark"] = sum((s_ms - d_ms).values())
        res["n_only_oracle"] = sum((d_ms - s_ms).values())
    return res


def main(argv):
    import importlib
    import json

    sys.path.insert(0, ".")
    entry = importlib.import_module("__spark_entry__")
    from ledgerline.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    keys = []
    for a in argv:
        if a.startswith("--sf="):
            sf_dir = a.split("=", 1)[1]
        else:
            keys.append(a)
    spark = local_session()
    con = duck(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    keys = keys or list(qs)
    bad = 0
    for k in keys:
        try:
            df = qs[k](spark, sf_dir)
            if k not in sqls:
                n = df.count()
                print(json.dumps({"key": k, "rows_only": n}))
                continue
            r = compare(spark, con, df, sqls[k])
        except Exception as e:  # report and continue
            r = {"ok": False, "error": repr(e)[:800]}
        r["key"] = k
        bad += 0 if r.get("ok") else 1
        if r.get("ok"):
            r.pop("types", None)
        print(json.dumps(r, default=str))
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
