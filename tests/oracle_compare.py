"""Run a registered Spark query and its DuckDB oracle SQL; compare the results.

Usable from tests and as a script:
    python tests/oracle_compare.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import decimal
import math
import os
import sys

import duckdb
import pyarrow as pa

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return v
    if isinstance(v, decimal.Decimal):
        return v
    return v


def _rows(table: pa.Table) -> list[tuple]:
    cols = sorted(table.column_names)
    data = [table.column(c).to_pylist() for c in cols]
    rows = [tuple(_norm(v) for v in r) for r in zip(*data)] if data else []
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name: str, spark_df, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck_connection(sf_dir)
    s_tab = spark_df.toArrow()
    d_tab = con.sql(sql).to_arrow_table()
    out = {"name": name, "spark_rows": s_tab.num_rows, "oracle_rows": d_tab.num_rows}
    s_cols, d_cols = sorted(s_tab.column_names), sorted(d_tab.column_names)
    out["columns_match"] = s_cols == d_cols
    if not out["columns_match"]:
        out["only_spark"] = sorted(set(s_cols) - set(d_cols))
        out["only_oracle"] = sorted(set(d_cols) - set(s_cols))
        out["ok"] = False
        return out
    type_diff = {}
    for c in s_cols:
        st, dt = s_tab.schema.field(c).type, d_tab.schema.field(c).type
        if st != dt:
            type_diff[c] = (str(st), str(dt))
    out["type_diff"] = type_diff
    srows, drows = _rows(s_tab), _rows(d_tab)
    out["values_match"] = srows == drows
    if not out["values_match"]:
        diffs = []
        sset, dset = set(srows), set(drows)
        only_s = [r for r in srows if r not in dset][:3]
        only_d = [r for r in drows if r not in sset][:3]
        out["sample_only_spark"] = only_s
        out["sample_only_oracle"] = only_d
        out["n_only_spark"] = len([r for r in srows if r not in dset])
        if only_s and only_d:
            for i, (a, b) in enumerate(zip(only_s[0], only_d[0])):
                if a != b:
                    diffs.append((s_cols[i], a, b))
        out["first_diff_cols"] = diffs
    out["ok"] = out["values_match"] and out["spark_rows"] == out["oracle_rows"] and not type_diff
    return out


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as entry

    from bazaar.session import build_session

    spark = build_session("local[8]", shuffle_partitions=8)
    qs, sqls = entry.queries(), entry.oracle_sql()
    names = argv[2:] or list(qs)
    con = duck_connection(sf_dir)
    bad = 0
    for name in names:
        if name not in sqls:
            df = qs[name](spark, sf_dir)
            print(f"{name:40s} rows-only {df.count()}")
            continue
        try:
            res = compare(spark, name, qs[name](spark, sf_dir), sqls[name], sf_dir, con)
        except Exception as exc:  # report and continue
            bad += 1
            print(f"{name:40s} ERROR {type(exc).__name__}: {str(exc)[:400]}")
            continue
        flag = "OK " if res["ok"] else "BAD"
        bad += 0 if res["ok"] else 1
        print(f"{name:40s} {flag} rows {res['spark_rows']}/{res['oracle_rows']}", end="")
        if not res["ok"]:
            print(" ", {k: v for k, v in res.items() if k not in ("name", "spark_rows", "oracle_rows", "ok")})
        else:
            print()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
