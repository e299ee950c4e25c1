"""Compares a Spark result with DuckDB on the same parquet tables."""

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _normal(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)].astype(object)
    pdf = pdf.where(pdf.notna(), None)
    return sorted(map(tuple, pdf.itertuples(index=False)), key=repr)


def assert_same(df, con, sql):
    got, want = df.toPandas(), con.execute(sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    got, want = _normal(got), _normal(want)
    for a, b in zip(got, want):
        assert a == b
