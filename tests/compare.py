"""Runs registered queries beside their DuckDB statements and reports differences.

    python tests/compare.py [sf_dir] [query ...]
"""

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
import __spark_entry__ as entry  # noqa: E402


def session(cores: str = "8", shuffles: str = "8") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", shuffles)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def differences(spark, con, name: str, sf_dir: str) -> str:
    """Empty if both sides agree."""
    df = entry.queries()[name](spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return "" if got else "no rows"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = _rows(columns, cur.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"columns {df.columns} != {columns}"
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(got)} rows, want {len(want)}; {len(bad)} differ, first {str(bad[:1])[:600]}"
    return "" if got else "no rows"


def main() -> None:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and "/" in args[0] else "/root/testdata/sf0.01"
    spark, con = session(), oracle_connection(sf_dir)
    for name in args or entry.queries():
        start = time.time()
        try:
            found = differences(spark, con, name, sf_dir)
        except Exception as e:
            found = f"{type(e).__name__}: {str(e)[:1200]}"
        print(f"{'ok  ' if not found else 'FAIL'} {name:22} {time.time() - start:6.2f}s {found}", flush=True)


if __name__ == "__main__":
    main()
