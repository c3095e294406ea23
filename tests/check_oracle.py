"""Each query against its SQL on DuckDB, whole results.

    python tests/check_oracle.py [sf] [name ...]
"""

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    text = frame.astype(object).where(frame.notna(), None).map(lambda v: None if v is None else str(v))
    return sorted(text.itertuples(index=False, name=None), key=repr)


def differs(spark_frame, sql_frame):
    """None, or what tells the two results apart."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} and {sorted(sql_frame.columns)}"
    ours, theirs = rows_of(spark_frame), rows_of(sql_frame)
    if len(ours) != len(theirs):
        return f"{len(ours)} and {len(theirs)} rows"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"{a} and {b}"
    return None


def main(sf="0.01", *names):
    from __spark_entry__ import oracle_sql, queries
    from clicksieve.session import build_session

    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    folder = f"/root/testdata/sf{sf}"
    con, sql, failed = connect(folder), oracle_sql(), 0
    for name, query in queries().items():
        if not names and name.startswith(("op", "pipeline")):
            continue
        if names and name not in names:
            continue
        start = time.time()
        try:
            frame = query(spark, folder).toPandas()
            took = time.time() - start
            problem = differs(frame, con.execute(sql[name]).df()) if name in sql else "no SQL"
        except Exception as error:  # noqa: BLE001
            took, frame, problem = time.time() - start, [], str(error)[:1500]
        failed += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:34s} {len(frame):8d} rows {took:6.2f} s  {problem or ''}", flush=True)
    print("failed:", failed)


if __name__ == "__main__":
    main(*sys.argv[1:])
