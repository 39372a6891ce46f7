"""Compare a Spark result with its SQL twin on DuckDB."""

import glob
import math
import os

import duckdb

TESTDATA = "/root/testdata"

# Type names that both engines use for the same values.
SAME = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(value):
    """Comparable form; negative zero and NaN are told apart from 0.0."""
    if isinstance(value, float) and (math.isnan(value) or str(value) == "-0.0"):
        return str(value)
    return value


def sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def differences(df, con, sql):
    """Human-readable differences; an empty list means equal results."""
    out = con.execute(sql)
    names = [d[0] for d in out.description]
    types = {d[0]: str(d[1]) for d in out.description}
    theirs = out.fetchall()
    cols = sorted(df.columns)
    if cols != sorted(names):
        return [f"columns {cols} != {sorted(names)}"]
    found = [
        f"type of {c}: {t} / {types[c]}" for c, t in df.dtypes if SAME.get(t) != types[c]
    ]
    order = [names.index(c) for c in cols]
    a = sorted(
        (tuple(canonical(v) for v in row) for row in df.select(*cols).collect()), key=sort_key
    )
    b = sorted(
        (tuple(canonical(row[i]) for i in order) for row in theirs), key=sort_key
    )
    if len(a) != len(b):
        found.append(f"rows {len(a)} != {len(b)}")
    bad = [(x, y) for x, y in zip(a, b, strict=False) if x != y]
    if bad:
        found.append(f"{len(bad)} of {len(a)} rows differ, e.g. {bad[:2]}")
    return found
