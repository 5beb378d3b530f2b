"""Running a query's SQL oracle in DuckDB and comparing rows."""

import decimal
import os

import duckdb


def _plain(v):
    if isinstance(v, (float, decimal.Decimal)):
        return f"{float(v):.9g}"
    if isinstance(v, (list, tuple)):
        return tuple(map(_plain, v))
    return v


def rows_of(records, columns):
    return sorted(repr(tuple(_plain(r[c]) for c in columns)) for r in records)


def oracle(sql, sf_dir, **frames):
    """Rows and column names of ``sql`` over the Parquet tables of ``sf_dir``, or over pandas frames given by name."""
    con = duckdb.connect()
    for f in sorted(os.listdir(sf_dir)) if sf_dir else []:
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{sf_dir}/{f}'")
    for name, frame in frames.items():
        con.register(name, frame)
    found = con.sql(sql)
    names = [d[0] for d in found.description]
    return [dict(zip(names, r)) for r in found.fetchall()], names


def same(df, sql, sf_dir, **frames):
    expected, names = oracle(sql, sf_dir, **frames)
    columns = sorted(df.columns)
    assert columns == sorted(names)
    got = [r.asDict() for r in df.collect()]
    assert rows_of(got, columns) == rows_of(expected, columns)
