"""Run registered queries against their SQL in DuckDB. As a script: ``oracle.py [sf] [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    return (1, repr(float(value)) if isinstance(value, float) else str(value))


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a DataFrame and a SQL result: columns, types, rows."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    ours = {f.name: f.dataType.simpleString() for f in df.schema}
    theirs = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in result.description}
    out = [] if ours == theirs else [f"schema: spark {ours} duckdb {theirs}"]
    if sorted(ours) != sorted(theirs):
        return out
    order = sorted(names)
    expected = sorted(tuple(_cell(row[names.index(c)]) for c in order) for row in result.fetchall())
    got = sorted(tuple(_cell(row[c]) for c in order) for row in df.collect())
    if len(expected) != len(got):
        out.append(f"rows: spark {len(got)} duckdb {len(expected)}")
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    if wrong:
        out.append(f"values: {len(wrong)} rows differ, first spark {wrong[0][0]} duckdb {wrong[0][1]}")
    return out


if __name__ == "__main__":
    from cohortry.plans.oracles import ORACLES
    from cohortry.plans.registry import QUERIES
    from cohortry.session import get_spark

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_spark("local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            if name in ORACLES:
                status = differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) or "ok"
            else:
                status = f"rows {len(QUERIES[name](spark, sf_dir).collect())}"
        except Exception as error:
            status = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        print(f"{name:34s} {time.time() - start:6.2f}s {status}", flush=True)
