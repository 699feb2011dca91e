"""Compare every registered query with its DuckDB counterpart: python tests/compare.py [folder] [names...]"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from catalog.bindings import TABLES  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    return value


def rows(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in records), key=repr)


def difference(spark, con, name: str, sf_dir: str) -> str | None:
    """None when names and values agree, else a short account."""
    df = entry.queries()[name](spark, sf_dir)
    ours = rows(df.columns, df.collect())
    cursor = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    theirs = rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} / {sorted(names)}"
    if ours != theirs:
        ours_only = [r for r in ours if r not in theirs][:2] if len(ours) < 5000 else []
        theirs_only = [r for r in theirs if r not in ours][:2] if len(ours) < 5000 else []
        if not ours_only and not theirs_only:
            pair = next(((a, b) for a, b in zip(ours, theirs) if a != b), None)
            return f"{len(ours)} / {len(theirs)} rows; {pair}"
        return f"{len(ours)} / {len(theirs)} rows; {ours_only} / {theirs_only}"
    return None


if __name__ == "__main__":
    from postmill.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    session = local_session("8", **{"spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or entry.queries():
        start = time.time()
        try:
            problem = difference(session, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{time.time() - start:6.1f}s {name}: {problem or 'ok'}", flush=True)
    print("different:", bad)
