"""Run a query and its SQL oracle on the same tables and compare every value."""

import glob
import os
import sys
import time

import duckdb


def duck(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    values = [tuple(row[i] for i in order) for row in rows]
    return sorted(columns), sorted(values, key=repr)


def difference(spark, sf_dir, query, sql):
    """Empty text if both results agree, else what differs."""
    frame = query(spark, sf_dir)
    got_columns, got = normal(frame.columns, [tuple(r) for r in frame.collect()])
    connection = duck(sf_dir)
    result = connection.execute(sql)
    want_columns, want = normal([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w or [type(x) for x in g] != [type(x) for x in w]:
            return f"{sum(a != b for a, b in zip(got, want))} rows differ, first {g} != {w}"
    return ""


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from pyspark.sql import SparkSession

    import __spark_entry__ as contract

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    sqls = contract.oracle_sql()
    wanted = sys.argv[2:] or list(contract.queries())
    for key in wanted:
        start = time.time()
        try:
            verdict = difference(session, sys.argv[1], contract.queries()[key], sqls[key])
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{key}: {verdict or 'ok'} ({time.time() - start:.1f}s)", flush=True)
