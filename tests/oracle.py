"""Run registered queries against DuckDB and compare columns, types and values."""

from __future__ import annotations

import datetime as dt
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

TYPES = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if v != v else repr(0.0 if v == 0 else v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v)


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> list[str]:
    """Differences between the Spark result and the SQL result; empty when equal."""
    cur = con.execute(sql)
    d_names = [c[0] for c in cur.description]
    d_types = {c[0]: TYPES.get(str(c[1]), str(c[1])) for c in cur.description}
    d_raw = cur.fetchall()
    s_types = dict(df.dtypes)
    out = []
    if set(d_names) != set(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(d_names)}"]
    for n in d_names:
        if s_types[n] != d_types[n]:
            out.append(f"type of {n}: {s_types[n]} vs {d_types[n]}")
    s_raw = df.collect()
    s, d = _rows(df.columns, s_raw), _rows(d_names, d_raw)
    if len(s) != len(d):
        out.append(f"rows {len(s)} vs {len(d)}")
    if s != d:
        only_s, only_d = sorted(set(s) - set(d)), sorted(set(d) - set(s))
        out.append(f"values differ in {len(only_s)}/{len(only_d)} rows; {sorted(df.columns)}")
        out += [f"  spark {r}"[:600] for r in only_s[:4]] + [f"  duck  {r}"[:600] for r in only_d[:4]]
    return out


def main(argv):
    from parcelflow.session import local_session

    import __spark_entry__ as entry

    sf_dir = "/root/testdata/sf0.01"
    pats = []
    for a in argv:
        if a.startswith("sf"):
            sf_dir = f"/root/testdata/{a}"
        else:
            pats.append(a)
    spark = local_session()
    con = duck(sf_dir)
    runs, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in runs.items():
        if pats and not any(name.startswith(p) for p in pats):
            continue
        t = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                diff = compare(df, con, oracles[name])
                n = ""
            else:
                diff, n = [], f" rows={df.count()} (no SQL)"
        except Exception as e:  # noqa: BLE001
            diff, n = [f"{type(e).__name__}: {str(e)[:1500]}"], ""
        took = time.time() - t
        bad += bool(diff)
        print(f"{'BAD ' if diff else 'ok  '} {name:32s} {took:6.2f}s{n}", flush=True)
        for line in diff:
            print("       " + line)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
