"""Run a catalog query in Spark and in DuckDB and compare the whole results."""

from __future__ import annotations

import duckdb
import numpy as np
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def canonical(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns and rows in a fixed order; NULL and NaN alike."""
    frame = frame[sorted(frame.columns)].copy()
    for name in frame.columns:
        kind = frame[name].dtype
        if str(kind).startswith("datetime"):
            frame[name] = frame[name].astype("datetime64[us]").astype(str)
        elif kind == object or str(kind) in ("str", "string"):
            frame[name] = [None if pd.isna(v) else str(v) for v in frame[name]]
        elif kind == bool or str(kind) == "boolean":
            frame[name] = frame[name].astype(str)
        else:
            frame[name] = frame[name].astype(np.float64) + 0.0
    return frame.sort_values(list(frame.columns), ignore_index=True)


def differences(ours: pd.DataFrame, theirs: pd.DataFrame) -> str | None:
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    a, b = canonical(ours), canonical(theirs)
    for name in a.columns:
        left, right = a[name], b[name]
        same = (left == right) | (left.isna() & right.isna())
        if not same.all():
            first = int(np.argmin(same.to_numpy()))
            return (
                f"{int((~same).sum())} of {len(a)} values of {name} differ, row {first}:\n"
                f"{a.iloc[first].to_dict()}\n{b.iloc[first].to_dict()}"
            )
    return None
