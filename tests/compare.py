"""Run registered queries next to their SQL twins: ``python tests/compare.py SF_DIR [name ...]``."""

from __future__ import annotations

import glob
import os
import sys
import time
import traceback

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def normal(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf[sorted(pdf.columns)]
    return pdf.sort_values(list(pdf.columns)).reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None when equal, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} / {sorted(want.columns)}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    got, want = normal(got), normal(want)
    for c in got.columns:
        kinds = {got[c].dtype.kind, want[c].dtype.kind}
        if len(kinds - {"O"}) > 1 or got[c].dtype.itemsize != want[c].dtype.itemsize:
            return f"type of {c}: {got[c].dtype} / {want[c].dtype}"
    bad = (got != want) & ~(got.isna() & want.isna())
    if bad.values.any():
        at = bad.any(axis=1)
        return f"{at.sum()} of {len(got)} rows, columns {list(bad.columns[bad.any()])}\n{got[at].head(3)}\n{want[at].head(3)}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from urbanweave.session import build_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(sf_dir), oracle_sql(), 0
    for name, fn in queries().items():
        if names and name not in names:
            continue
        try:
            start = time.time()
            got = fn(spark, sf_dir).toPandas()
            spark_s = time.time() - start
            if name not in sqls:
                print(f"rows  {name}: {len(got)} rows, {spark_s:.1f}s", flush=True)
                continue
            start = time.time()
            want = con.execute(sqls[name]).fetchdf()
            problem = difference(got, want)
            bad += problem is not None
            print(f"{'OK   ' if problem is None else 'DIFF '} {name}: {len(got)} rows, {spark_s:.1f}s / {time.time() - start:.1f}s"
                  + (f"\n{problem}" if problem else ""), flush=True)
        except Exception as exc:
            bad += 1
            text = "".join(traceback.format_exception_only(exc))[:1200]
            print(f"FAIL  {name}: {text}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main())
