"""Row-level filters and projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_where(df: DataFrame, condition: Column, columns: list[str]) -> DataFrame:
    """Rows that meet a condition, some columns only; an empty result keeps its schema."""
    return df.filter(condition).select(*columns)


def people_over(df: DataFrame, age: int = 28) -> DataFrame:
    """Names and ages above a bound; null ages fall out."""
    return select_where(df, F.col("age") > age, ["name", "age"])
