"""Run registered queries against their check statements: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import decimal
import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb
from pyspark.sql import SparkSession

from __spark_entry__ import oracle_sql, queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def database(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{directory}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, decimal.Decimal):
        return f"decimal {value}"
    return repr(value)


def _rows(rows, order):
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark, con, run, sql, directory) -> tuple[bool, str]:
    df = run(spark, directory)
    ours, mine = df.collect(), df.columns
    result = con.execute(sql)
    theirs, cols = result.fetchall(), [d[0] for d in result.description]
    if sorted(mine) != sorted(cols):
        return False, f"columns differ: ours only {set(mine) - set(cols)}, check only {set(cols) - set(mine)}"
    a = _rows(ours, [mine.index(c) for c in sorted(mine)])
    b = _rows(theirs, [cols.index(c) for c in sorted(mine)])
    if len(a) != len(b):
        return False, f"rows {len(a)} vs {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        x, y = bad[0]
        where = [f"{c}: {p} vs {r}" for c, p, r in zip(sorted(mine), x, y) if p != r]
        return False, f"{len(bad)} of {len(a)} rows differ, e.g. {x[:6]} -> {where[:5]}"
    return True, f"{len(a)} rows"


def main() -> int:
    directory = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark, con, sql = session(), database(directory), oracle_sql()
    failures = 0
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        began = time.time()
        try:
            if name in sql:
                ok, note = compare(spark, con, run, sql[name], directory)
            else:
                ok, note = True, f"no check statement, {len(run(spark, directory).collect())} rows"
        except Exception as error:  # report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        failures += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:32s} {time.time() - began:6.1f}s  {note}", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    raise SystemExit(main())
