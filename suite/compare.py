"""Run checks on both sides: ``python -m suite.compare [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

from rollcall.session import build_session

from .registry import load

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(spark, con, check, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    df = check.run(spark, sf_dir)
    columns = sorted(df.columns)
    ours = Counter(tuple(r) for r in df.select(*[f"`{c}`" for c in columns]).collect())
    if check.sql is None:
        return None if ours else "no rows"
    found = con.execute(check.sql)
    their_columns = [d[0] for d in found.description]
    if sorted(their_columns) != columns:
        return f"columns {columns} against {sorted(their_columns)}"
    order = [their_columns.index(c) for c in columns]
    kinds = {d[0]: str(d[1]) for d in found.description}
    theirs = Counter(tuple(r[i] for i in order) for r in found.fetchall())
    if ours != theirs:
        return (f"{sum(ours.values())} rows against {sum(theirs.values())}; only ours {list((ours - theirs))[:2]}, "
                f"only theirs {list((theirs - ours))[:2]} in {columns}")
    odd = [f"{c}:{dict(df.dtypes)[c]}/{kinds[c]}" for c in columns if kinds[c] in ("HUGEINT", "DECIMAL")]
    return f"types {odd}" if odd else None


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session("compare", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failed = 0
    for name, check in load().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        began = time.time()
        try:
            problem = compare(spark, con, check, sf_dir)
        except Exception as error:  # noqa: BLE001 - reported per check
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - began:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
