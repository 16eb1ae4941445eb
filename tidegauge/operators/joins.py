"""Joins of facts with dimensions that hold up when one key has a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegauge.functions.columns import col
from tidegauge.session import broadcast_limit, estimated_bytes

_SALT = "_salt"


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's size estimate is known and within the session's broadcast bound."""
    size = estimated_bytes(df)
    return size is not None and size <= broadcast_limit(df.sparkSession)


def hot_keys(rows: DataFrame, keys: list[str], share: float = 0.01) -> list[tuple]:
    """The keys that hold ``share`` of the rows or more, at most 1 / ``share`` of them.

    Counted over all rows before they are shuffled, as one row per key and task. For a stream, ask
    what has landed so far.
    """
    counts = rows.groupBy(*[col(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    total = rows.count()
    return [tuple(r)[:-1] for r in counts.filter(F.col("_n") >= max(1, share * total)).collect()]


def _is_hot(df: DataFrame, keys: list[str], hot: list[tuple]) -> Column:
    found = F.lit(False)
    for values in hot:
        same = [col(k).eqNullSafe(F.lit(v).cast(df.schema[k].dataType)) for k, v in zip(keys, values)]
        found = found | reduce(Column.__and__, same)
    return found


def dimension_join(
    facts: DataFrame,
    dimension: DataFrame,
    keys: list[str],
    how: str = "left",
    salts: int = 16,
    hot: list[tuple] | None = None,
) -> DataFrame:
    """Join facts, streaming or not, with a static table that is unique by key.

    No hint is given: Spark broadcasts the table when its own size check allows it. For a stream
    with a larger table the join is salted, since streams get no adaptive skew handling: facts are
    spread over ``salts`` copies of the dimension. With ``hot``, the keys that ``hot_keys`` found,
    only those are spread and copied. Batch joins leave skew to the adaptive planner.
    """
    if how not in ("left", "inner"):
        raise ValueError("facts may be joined left or inner")
    if not facts.isStreaming or salts <= 1 or fits_broadcast(dimension):
        return facts.join(dimension, keys, how)
    salt, copies = F.floor(F.rand(17) * salts).cast("int"), F.sequence(F.lit(0), F.lit(salts - 1))
    if hot is not None:
        salt = F.when(_is_hot(facts, keys, hot), salt).otherwise(0)
        copies = F.when(_is_hot(dimension, keys, hot), copies).otherwise(F.array(F.lit(0)))
    salted = facts.withColumn(_SALT, salt)
    return salted.join(dimension.withColumn(_SALT, F.explode(copies)), [*keys, _SALT], how).drop(_SALT)


def aggregate_then_join(
    facts: DataFrame,
    fact_keys: list[str],
    measures: list,
    dimension: DataFrame,
    dimension_keys: list[str],
    how: str = "inner",
) -> DataFrame:
    """Pre-aggregate facts by key before they meet the dimension: a hot key becomes one row."""
    summed = facts.groupBy(*[col(k) for k in fact_keys]).agg(*measures)
    for fact_key, dimension_key in zip(fact_keys, dimension_keys):
        summed = summed.withColumnRenamed(fact_key, dimension_key)
    return summed.join(dimension, dimension_keys, how)
