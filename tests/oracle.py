"""Row-by-row comparison of a registered query with its SQL on the same files."""

import math

import duckdb

from foldmark.catalog.fixtures import TABLES


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, float):
        if math.isnan(value):
            return (2, "nan")
        return (2, repr(value))
    return (3, repr(value))


def compare(df, con, sql):
    """None when equal, else a short description of the first difference."""
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    expected = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    order = sorted(names)
    got = [[row[c] for c in order] for row in df.collect()]
    place = [names.index(c) for c in order]
    want = [[row[i] for i in place] for row in expected]
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    got, want = (sorted([[_cell(v) for v in row] for row in rows]) for rows in (got, want))
    for a, b in zip(got, want):
        if a != b:
            return f"{dict(zip(order, a))} against {dict(zip(order, b))}"
    return None
