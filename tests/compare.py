"""Run registered queries next to their SQL and compare columns, row counts and values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return value


def difference(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs. Values are compared exactly."""
    names = sorted(spark_df.columns)
    result = con.execute(sql)
    duck_names = [d[0] for d in result.description]
    if names != sorted(duck_names):
        return f"columns {names} vs {sorted(duck_names)}"
    order = [duck_names.index(n) for n in names]
    theirs = sorted((str([_plain(row[i]) for i in order]) for row in result.fetchall()))
    ours = sorted(str([_plain(row[n]) for n in names]) for row in spark_df.collect())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} vs {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} of {len(ours)} rows, first {wrong[0]}" if wrong else None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from tillweave import session

    sf, only = sys.argv[1], sys.argv[2:]
    spark = session.build(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g", "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC", "spark.log.level": "ERROR",
    })
    con, sqls = duck(sf), entry.oracle_sql()
    for name, query in entry.queries().items():
        if only and not any(name == o or (o.endswith("*") and name.startswith(o[:-1])) for o in only):
            continue
        start = time.time()
        try:
            df = query(spark, sf)
            n = len(df.collect())
            middle = time.time()
            wrong = difference(df, con, sqls[name]) if name in sqls else "no SQL"
        except Exception as error:  # noqa: BLE001
            n, middle, wrong = -1, time.time(), f"{type(error).__name__}: {str(error)[:900]}"
        print(f"\n{'ok ' if wrong is None else 'BAD'} {name} rows={n} {middle - start:.1f}s +{time.time() - middle:.1f}s {wrong or ''}", flush=True)
