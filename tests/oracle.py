"""Compare a Spark frame with DuckDB SQL over the same tables."""

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir):
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(frame):
    columns = sorted(frame.columns)
    frame = frame[columns].astype(object).where(pd.notnull(frame[columns]), None)
    return columns, sorted((tuple(r) for r in frame.itertuples(index=False)), key=repr)


def difference(spark_frame, con, sql):
    """None when both give the same rows, else a short description."""
    spark_columns, got = _rows(spark_frame.toPandas())
    sql_columns, want = _rows(con.sql(sql).df())
    if spark_columns != sql_columns:
        return f"columns {spark_columns} != {sql_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{str(g)[:600]} != {str(w)[:600]}"
    return None
