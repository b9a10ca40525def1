"""Run registered queries against their SQL on DuckDB: python tests/oracle_check.py [sf_dir] [query ...]"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(pdf):
    """Rows as sorted text tuples over the columns in name order."""
    import pandas as pd

    def cell(v):
        if v is None or v is pd.NaT or v is pd.NA or v != v:
            return "∅"
        if hasattr(v, "isoformat"):
            return pd.Timestamp(v).isoformat()
        if isinstance(v, bool) or type(v).__name__ == "bool_":
            return str(bool(v))
        if isinstance(v, (int, float)) or hasattr(v, "dtype"):
            return repr(float(v))
        return str(v)

    cols = sorted(pdf.columns)
    return cols, sorted(tuple(cell(v) for v in row) for row in pdf[cols].itertuples(index=False, name=None))


def compare(left, right) -> str | None:
    """None when both frames hold the same rows, else a short description."""
    lc, lr = canonical(left)
    rc, rr = canonical(right)
    if lc != rc:
        return f"columns {lc} vs {rc}"
    if lr == rr:
        return None
    only_l, only_r = sorted(set(lr) - set(rr)), sorted(set(rr) - set(lr))
    return f"rows {len(lr)} vs {len(rr)}; only spark {only_l[:2]}; only sql {only_r[:2]}"


def main() -> int:
    import __spark_entry__ as e
    from conftest import session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con = session(), connect(sf)
    queries, sql = e.queries(), e.oracle_sql()
    bad = 0
    for name, run in queries.items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        got = run(spark, sf).toPandas()
        took = time.time() - t
        diff = compare(got, con.execute(sql[name]).fetch_df()) if name in sql else "no SQL"
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name:24s} rows={len(got):6d} {took:5.1f}s {diff or ''}"[:900], flush=True)
    print(f"{bad} differing")
    return bad


if __name__ == "__main__":
    sys.exit(main())
