"""Comparison of a query with its SQL on the same files."""

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir):
    c = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        c.sql(f"create view {os.path.basename(p)[:-8]} as select * from '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def normal(frame):
    frame = frame[sorted(frame.columns)]
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


def same(query, sql, spark, sf_dir):
    got, want = normal(query(spark, sf_dir).toPandas()), normal(connect(sf_dir).sql(sql).df())
    pd.testing.assert_frame_equal(got, want, check_dtype=False)
