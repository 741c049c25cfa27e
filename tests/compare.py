"""Run registered queries in Spark and their SQL in DuckDB and compare the rows."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _canonical(frame):
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object)
    rows = [tuple(r) for r in plain.where(plain.notna(), None).itertuples(index=False, name=None)]
    return columns, sorted(rows, key=lambda r: tuple((v is None, str(v)) for v in r))


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else a short description."""
    ours = spark_df.toPandas()
    theirs = con.execute(sql).df()
    for c in set(ours.columns) & set(theirs.columns):  # a long with nulls
        if str(theirs[c].dtype) == "Int64" and str(ours[c].dtype) in ("float64", "int64", "object"):
            ours[c] = ours[c].astype("Int64")
    a, b = _canonical(ours), _canonical(theirs)
    if a[0] != b[0]:
        return f"columns {a[0]} != {b[0]}"
    kinds = [(c, str(ours[c].dtype), str(theirs[c].dtype)) for c in a[0] if str(ours[c].dtype) != str(theirs[c].dtype)]
    kinds = [k for k in kinds if "datetime" not in k[1]]
    if kinds:
        return f"types {kinds}"
    if len(a[1]) != len(b[1]):
        return f"rows {len(a[1])} != {len(b[1])}"
    wrong = [(x, y) for x, y in zip(a[1], b[1]) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a[1])} rows differ, e.g. {wrong[0]}"
    return None


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from locusloom.session import local_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    chosen = sys.argv[1:]
    spark = local_session("compare")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, failed = oracle_sql(), 0
    for name, fn in queries().items():
        if chosen and name not in chosen:
            continue
        began = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in oracles:
                problem = difference(df, con, oracles[name])
            else:
                problem = None if df.count() >= 0 else "no rows"
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - began:.2f}s {problem or ''}", flush=True)
    missing = sorted(set(oracles) - set(queries()))
    print("oracles without query:", missing, "failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
