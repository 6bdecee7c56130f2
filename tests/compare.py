"""Spark result against DuckDB result, order and column order ignored."""

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(file)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    return con


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(row[name] for name in names) for row in df.collect())


def duck_rows(con, sql):
    result = con.execute(sql)
    columns = [column[0] for column in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    return [columns[i] for i in order], rows
