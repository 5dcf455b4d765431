"""Run registered queries against their SQL on one data directory and report differences.

    python tests/compare.py <sf_dir> [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if value is None:
        return ("null",)
    if isinstance(value, bool):
        return ("bool", value)
    if isinstance(value, float):
        return ("num", round(value, 6) + 0.0)
    if isinstance(value, int):
        return ("num", float(value))
    return ("text", str(value))


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql) -> tuple[str, int]:
    cursor = con.execute(sql)
    expected_names = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(df.columns) != sorted(expected_names):
        return f"columns differ: {sorted(df.columns)} != {sorted(expected_names)}", 0
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want = rows_of(expected_names, expected)
    if got == want:
        return "", len(got)
    extra, lacking = [r for r in got[:5000] if r not in set(want)], [r for r in want[:5000] if r not in set(got)]
    return f"{len(got)} rows against {len(want)}; only ours {extra[:2]}; only theirs {lacking[:2]}", len(got)


def main() -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract
    from siteloom.session import configure

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    con, failed = connect(sf_dir), 0
    sql = contract.oracle_sql()
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        begun = time.time()
        try:
            difference, n = compare(query(spark, sf_dir), con, sql[name])
        except Exception as error:  # report and go on
            difference, n = f"{type(error).__name__}: {str(error)[:600]}", 0
        failed += bool(difference)
        print(f"{'FAIL' if difference else 'ok  '} {name} rows={n} {time.time() - begun:.1f}s {difference}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
