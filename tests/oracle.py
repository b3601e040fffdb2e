"""Compare a Spark result with DuckDB's, ignoring row order."""

import contextlib
import glob
import io
import os

import duckdb


def connect(sf_dir):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def canonical(columns, rows):
    """Rows with columns in name order, values as text, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(connection, sql):
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), canonical(columns, cursor.fetchall())


def plan(df):
    """The formatted physical plan of ``df``."""
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()
