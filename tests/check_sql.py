"""Run registered queries and their SQL side by side: ``python tests/check_sql.py [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from crawlspark import catalog  # noqa: E402
from crawlspark.session import build_session  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name: str, sf_dir: str, queries=None, oracles=None) -> str:
    """``''`` when names, types and the multiset of rows agree, else what differs."""
    oracles = catalog.ORACLES if oracles is None else oracles
    df = (catalog.run(name) if queries is None else queries[name])(spark, sf_dir)
    cols = sorted(df.columns)
    got = sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
    if name not in oracles:
        return ""
    rel = con.sql(oracles[name])
    if sorted(rel.columns) != cols:
        return f"columns {cols} / {sorted(rel.columns)}"
    kinds = dict(zip(rel.columns, map(str, rel.types)))
    odd = {c: (t, kinds[c]) for c, t in df.dtypes if TYPES.get(t) != kinds[c] and kinds[c] != '"NULL"'}
    want = sorted((tuple(r) for r in rel.select(*[duckdb.ColumnExpression(c) for c in cols]).fetchall()), key=repr)
    if got != want:
        extra = [r for r in got if r not in set(want)][:3]
        lost = [r for r in want if r not in set(got)][:3]
        return f"rows {len(got)} / {len(want)}; only here {extra!r:.600}; only there {lost!r:.600}"
    return f"types {odd}" if odd else ("" if got else "no rows")


def main() -> int:
    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.01"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names or catalog.QUERIES:
        start = time.time()
        try:
            problem = compare(spark, con, name, sf_dir)
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:700]}"
        bad += bool(problem)
        note = "" if name in catalog.ORACLES else " (rows only)"
        print(f"{'FAIL' if problem else 'ok  '} {name}{note} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{bad} problems")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
