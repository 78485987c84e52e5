"""Runs a query's SQL in DuckDB over the same parquet tables."""

import duckdb

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def rows(sql, d, columns):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{d}/{name}.parquet'")
    return sorted((tuple(r) for r in con.execute(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall()), key=str)


def same(df, sql, d):
    got = sorted((tuple(r) for r in df.collect()), key=str)
    assert got == rows(sql, d, df.columns)
