"""A query of this package against its SQL."""

import glob
import os

import duckdb

from docflow.llm import queries


def normal(x):
    return round(x, 9) if isinstance(x, float) else x


def compare(spark, sf_dir, name):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    cursor = con.execute(queries.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    want = sorted((tuple(map(normal, r)) for r in cursor.fetchall()), key=str)
    found = queries.QUERIES[name](spark, sf_dir)
    assert sorted(found.columns) == sorted(columns)
    got = sorted((tuple(map(normal, r)) for r in found.select(*columns).collect()), key=str)
    assert got == want, [x for x in zip(got, want, strict=False) if x[0] != x[1]][:3]
    return len(got)
