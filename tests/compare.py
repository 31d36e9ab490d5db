"""Run registered queries next to their SQL twins and compare the rows."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        files = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{files}')")
    return con


def difference(spark, con, name, query, sql, sf_dir) -> str | None:
    """None when columns and rows agree, otherwise what differs."""
    df = query(spark, sf_dir)
    columns = sorted(df.columns)
    ours = Counter(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    found = con.sql(sql)
    if sorted(found.columns) != columns:
        return f"columns {columns} against {sorted(found.columns)}"
    picked = ", ".join(f'"{c}"' for c in columns)
    theirs = Counter(con.sql(f"SELECT {picked} FROM ({sql})").fetchall())
    if ours == theirs:
        return None if ours else "no rows on either side"
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; only here "
        f"{list((ours - theirs))[:2]}; only in SQL {list((theirs - ours))[:2]}"
    )


def main() -> None:
    import __spark_entry__ as entry
    from chronomart.session import build_session

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = build_session("compare", "local[8]", spark__ui__enabled="false",
                          spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = entry.oracle_sql()
    bad = 0
    for name, query in entry.queries().items():
        if wanted and not any(w in name for w in wanted):
            continue
        t = time.time()
        try:
            result = difference(spark, con, name, query, sqls[name], sf_dir)
        except Exception as e:  # noqa: BLE001
            result = f"{type(e).__name__}: {str(e)[:700]}"
        bad += result is not None
        print(f"{'ok  ' if result is None else 'FAIL'} {name} {time.time() - t:.2f}s {result or ''}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
