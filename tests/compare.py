"""Run queries next to their SQL: python tests/compare.py [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    db = duckdb.connect()
    db.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def plain(value):
    return float(f"{value:.12g}") if isinstance(value, float) else value


def difference(spark_df, db, sql: str) -> str:
    """Empty when both results hold the same rows."""
    names = sorted(spark_df.columns)
    cursor = db.execute(sql)
    found = [c[0] for c in cursor.description]
    if sorted(found) != names:
        return f"columns {names} <> {sorted(found)}"
    order = [found.index(n) for n in names]
    wanted = Counter(tuple(plain(r[i]) for i in order) for r in cursor.fetchall())
    got = Counter(tuple(plain(v) for v in r) for r in spark_df.select(*[f"`{n}`" for n in names]).collect())
    if got == wanted:
        return ""
    extra, lost = list((got - wanted).items())[:2], list((wanted - got).items())[:2]
    return f"{names} rows {sum(got.values())} <> {sum(wanted.values())}\n   spark only {str(extra)[:700]}\n   sql only   {str(lost)[:700]}"


def main() -> int:
    from pyspark.sql import SparkSession

    from driver_queries import ORACLES, QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            problem = difference(QUERIES[name](spark, sf_dir), db, ORACLES[name])
        except Exception as failure:  # noqa: BLE001
            problem = f"{type(failure).__name__}: {str(failure)[:600]}"
        bad += bool(problem)
        print(f"{'BAD' if problem else 'ok '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{len(names) - bad}/{len(names)} equal")
    return int(bool(bad))


if __name__ == "__main__":
    sys.exit(main())
