"""Order-free comparison of two result tables."""

from __future__ import annotations

import decimal
import math

import pandas as pd


def _plain(value):
    if value is None or value is pd.NaT or value is pd.NA:
        return None
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if isinstance(value, decimal.Decimal):
        return float(value)
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, float)):
        return float(value)
    return str(value)


def _rows(df: pd.DataFrame) -> list[tuple]:
    names = sorted(df.columns)
    columns = [[_plain(v) for v in df[n]] for n in names]
    return sorted(zip(*columns), key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(got: pd.DataFrame, want: pd.DataFrame) -> str:
    """Empty when equal, else what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} != {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    names = sorted(got.columns)
    for a, b in zip(_rows(got), _rows(want)):
        if a != b:
            off = {n: (x, y) for n, x, y in zip(names, a, b) if x != y}
            return f"row differs (got, expected): {str(off)[:600]}"
    return ""
