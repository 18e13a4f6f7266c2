"""Run queries on Spark and their SQL on the checking engine, and compare rows, columns and values.

As a script: ``python tests/parity.py [NAME...]`` over the folder in ``PARITY_DIR``.
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def session(cores: int = 8) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
    spark = builder.config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def engine(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{source}')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, query, sql: str, folder: str) -> str:  # noqa: ANN001
    """Empty if both agree, else what differs."""
    df = query(spark, folder)
    names = sorted(df.columns)
    ours = Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    if sorted(columns) != names:
        return f"columns {names} and {sorted(columns)}"
    order = [columns.index(n) for n in names]
    theirs = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    if ours == theirs:
        return ""
    return f"{sum(ours.values())} and {sum(theirs.values())} rows; only here {list((ours - theirs))[:2]}; only there {list((theirs - ours))[:2]}"


def main(names: list[str]) -> int:
    import __spark_entry__ as entry
    from hammerlot.plans.materialize import release

    folder = os.environ.get("PARITY_DIR", "/root/testdata/sf0.01")
    spark, con = session(), engine(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or sorted(sql):
        began = time.time()
        try:
            difference = compare(spark, con, queries[name], sql[name], folder)
            release()
        except Exception as e:
            difference = f"{type(e).__name__}: {str(e)[:700]}"
        bad += bool(difference)
        print(f"{name}: {'ok' if not difference else difference[:1500]} ({time.time() - began:.1f} s)", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
