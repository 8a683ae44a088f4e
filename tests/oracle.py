"""Run a registered query and its SQL on the same tables and compare the rows."""

import glob
import math
import os

import duckdb


def sql_rows(sql, sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    con.execute("SET TimeZone = 'UTC'")
    result = con.execute(sql)
    return [c[0] for c in result.description], [str(c[1]) for c in result.description], result.fetchall()


def normal(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def _cell(value):
    return "NaN" if isinstance(value, float) and math.isnan(value) else value


def assert_same(frame, sql, sf_dir):
    columns, _, expected = sql_rows(sql, sf_dir)
    assert sorted(frame.columns) == sorted(columns)
    got = normal(frame.columns, [tuple(r) for r in frame.collect()])
    want = normal(columns, expected)
    assert len(got) == len(want)
    for mine, theirs in zip(got, want):
        assert mine == theirs
