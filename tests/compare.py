"""Side-by-side run of the registered queries in Spark and DuckDB."""

from __future__ import annotations

import os
import time

import duckdb

from gradmill.catalog.queries import TABLES


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(columns: list[str], rows: list[tuple]) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def difference(df, con, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    mine = canonical(df.columns, [tuple(r) for r in df.collect()])
    theirs = canonical(names, result.fetchall())
    if len(mine) != len(theirs):
        return f"{len(mine)} rows against {len(theirs)}"
    off = [(a, b) for a, b in zip(mine, theirs) if a != b]
    return f"{len(off)} of {len(mine)} rows differ, first {off[0]}" if off else None


def main(names: list[str]) -> int:
    import __spark_entry__ as entry
    from gradmill.session import get_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = get_session(
        "compare", {"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                    "spark.driver.memory": "8g"}, "local[8]",
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = query(spark, sf_dir)
            verdict = difference(df, con, oracles[name]) if name in oracles else f"rows {df.count()}"
        except Exception as e:  # noqa: BLE001 - report and go on
            verdict = f"ERROR {type(e).__name__}: {str(e)[:600]}"
        bad += name in oracles and verdict is not None or str(verdict).startswith("ERROR")
        print(f"{name:24s} {time.time() - t0:6.2f}s {verdict or 'ok'}", flush=True)
    return bad


if __name__ == "__main__":
    import sys

    sys.exit(main(sys.argv[1:]))
