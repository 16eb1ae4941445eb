"""Small column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_BRANCH = "master"


def quoted(name: str) -> str:
    """A column name safe against dots, spaces and backticks."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def cols(names: list[str]) -> list[Column]:
    return [col(n) for n in names]


def text_or_default(value: Column, default: str) -> Column:
    """``default`` where the text is null or empty."""
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))


def branch_or_default(value: Column) -> Column:
    return text_or_default(value, DEFAULT_BRANCH)


def tag(value: object) -> Column:
    """A literal text column; null stays a typed null."""
    return F.lit(value).cast("string")


def row_digest(df: DataFrame) -> Column:
    """A hash of the whole row, used only to order exact ties the same way on every run."""
    parts = [
        F.to_json(F.struct(col(f.name))) if _holds_map(f.dataType) else col(f.name)
        for f in df.schema
    ]
    return F.xxhash64(*parts)


def _holds_map(kind: T.DataType) -> bool:
    text = kind.simpleString()
    return "map<" in text or "variant" in text


def as_instant(value: Column) -> Column:
    """Event time as TIMESTAMP: watermarks refuse TIMESTAMP_NTZ."""
    return value.cast("timestamp")
