"""Compares a Spark query with its DuckDB SQL: columns by name, rows in any order, doubles to a small relative error."""

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def views(sf_dir: str):
    con = duckdb.connect(config={"threads": 2})
    for t in TABLES:
        if Path(f"{sf_dir}/{t}.parquet").exists():
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _key(row):
    return tuple((v is None, f"{v:.3f}" if isinstance(v, float) else str(v)) for v in row)


def _same(a, b) -> bool:
    if a is None or b is None:
        return a is b
    if isinstance(a, (int, float)) and isinstance(b, (int, float)) and not isinstance(a, bool):
        return math.isclose(a, b, rel_tol=1e-6, abs_tol=2e-5)
    return str(a) == str(b)


def differences(df, con, sql: str) -> list:
    """What differs: columns, the number of rows, or the first few rows."""
    names = sorted(df.columns)
    rel = con.sql(sql)
    if sorted(rel.columns) != names:
        return [("columns", names, sorted(rel.columns))]
    at = [rel.columns.index(n) for n in names]
    theirs = sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=_key)
    ours = sorted((tuple(r) for r in df.select(*[f"`{n}`" for n in names]).collect()), key=_key)
    if len(ours) != len(theirs):
        return [("rows", len(ours), len(theirs))]
    return [(dict(zip(names, a)), dict(zip(names, b))) for a, b in zip(ours, theirs) if not all(map(_same, a, b))][:3]
