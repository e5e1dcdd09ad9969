"""Run queries next to their SQL and report differences."""

from __future__ import annotations

import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def rows_of(frame) -> list[tuple]:
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted(
        (tuple(str(int(v)) if isinstance(v, (int, float)) and v == int(v) else str(v) for v in row)
         for row in plain.itertuples(index=False, name=None))
    )


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    mine = query(spark, sf_dir).toPandas()
    theirs = con.execute(sql).df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} / {sorted(theirs.columns)}"
    a, b = rows_of(mine), rows_of(theirs)
    if len(a) != len(b):
        return f"{len(a)} rows / {len(b)} rows"
    for x, y in zip(a, b):
        if x != y:
            return f"{x} / {y}"
    return None


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = sys.argv[1]
    session = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    for name, query in entry.queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            outcome = difference(session, con, query, oracles[name], sf_dir)
        except Exception as error:  # report and go on with the next query
            outcome = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:28s} {time.time() - start:6.1f}s {'ok' if outcome is None else outcome}", flush=True)
