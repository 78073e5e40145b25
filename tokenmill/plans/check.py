"""Side-by-side check of a registered query against its DuckDB oracle.

Used by the tests and by ``python -m tokenmill.plans.check [names...]``.
Comparison: same column names, same row count, same multiset of rows
after rounding floats to 6 places.
"""

from __future__ import annotations

import math
import sys
import time

from tokenmill.plans.catalog import TABLES


def duckdb_con(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        r = round(v, 6)
        return 0.0 if r == 0 else r
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, int):
        return v
    return str(v) if not isinstance(v, str) else v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, name: str, sf_dir: str, con=None, verbose: bool = False):
    from tokenmill.plans.registry import ORACLES, QUERIES
    con = con or duckdb_con(sf_dir)
    t0 = time.time()
    df = QUERIES[name](spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t1 = time.time()
    if name not in ORACLES:
        return {"name": name, "ok": None, "rows": len(s_rows), "spark_s": t1 - t0}
    rel = con.sql(ORACLES[name])
    o_cols = list(rel.columns)
    o_rows = rel.fetchall()
    res = {"name": name, "rows": len(s_rows), "oracle_rows": len(o_rows), "spark_s": round(t1 - t0, 2)}
    if sorted(s_cols) != sorted(o_cols):
        res.update(ok=False, why=f"columns {sorted(s_cols)} vs {sorted(o_cols)}")
        return res
    a, b = _rows(s_cols, s_rows), _rows(o_cols, o_rows)
    if a != b:
        diff = [x for x in a if x not in set(b)][:3]
        diff2 = [x for x in b if x not in set(a)][:3]
        res.update(ok=False, why=f"values differ; spark-only {diff}; oracle-only {diff2}")
        return res
    res["ok"] = True
    return res


def main(argv):
    from tokenmill.plans.registry import load_all
    from tokenmill.session import get_spark
    sf_dir = "/root/testdata/sf0.01"
    names = [a for a in argv if not a.startswith("--")]
    queries, _ = load_all()
    spark = get_spark("local[8]", shuffle_partitions=8, extra={"spark.driver.memory": "8g"})
    con = duckdb_con(sf_dir)
    bad = 0
    for n in names or sorted(queries):
        try:
            r = compare(spark, n, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "why": f"{type(e).__name__}: {str(e)[:400]}"}
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print(f"failed: {bad}")


if __name__ == "__main__":
    main(sys.argv[1:])
