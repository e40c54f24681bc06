"""Comparing query results with their SQL twins."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def database(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if value is None or value is pd.NA or value != value:
        return None
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or hasattr(value, "dtype"):
        return "0" if value == 0 else f"{float(value):.9g}" if math.isfinite(value) else str(value)
    text = str(value)
    return text.removesuffix(" 00:00:00")


def rows(frame) -> Counter:
    columns = sorted(frame.columns)
    return Counter(tuple(cell(v) for v in r) for r in frame[columns].astype(object).itertuples(index=False))
