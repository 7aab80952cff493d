"""Compare registered queries with their SQL: ``python tests/oracle.py sf_dir [name ...]``."""

import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    table = [tuple(plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(table, key=repr)


def compare(frame, db, sql):
    """None when equal, else a short text."""
    result = db.execute(sql)
    wanted = rows_of([d[0] for d in result.description], result.fetchall())
    got = rows_of(frame.columns, frame.collect())
    if wanted[0] != got[0]:
        return f"columns {got[0]} != {wanted[0]}"
    if len(wanted[1]) != len(got[1]):
        return f"rows {len(got[1])} != {len(wanted[1])}"
    for a, b in zip(got[1], wanted[1]):
        if a != b:
            return f"{a} != {b}"
        for x, y in zip(a, b):
            if type(x) is not type(y):
                return f"types {a} != {b}"
    return None


def main():
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    folder, names = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            frame = queries[name](spark, folder)
            if name in sql:
                problem = compare(frame, db, sql[name])
                note = "match" if problem is None else "DIFF " + problem[:600]
            else:
                problem = None
                note = f"rows only: {len(frame.collect())}"
        except Exception as error:  # report and go on
            problem, note = True, f"ERROR {str(error)[:900]}"
        bad += problem is not None
        print(f"{name:28s} {time.time() - start:6.1f}s {note}", flush=True)
    print("failed:", bad)
    sys.exit(bool(bad))


if __name__ == "__main__":
    main()
