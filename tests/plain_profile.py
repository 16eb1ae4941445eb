"""The plain form of a column profile, as a cross-check and a benchmark yardstick.

One wide aggregate with a distinct count per column, then one group-sort-limit job per numeric
column; everything is collected on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def plain_profile(df: DataFrame, split: bool = False) -> dict[str, dict]:
    """With ``split`` the distinct counts are an aggregate of their own."""
    total = df.count()
    wanted, distinct = [], []
    for field in df.schema:
        c, n = F.col(field.name), field.name
        wanted.append(F.count(c).alias(f"{n}|filled"))
        distinct.append(F.countDistinct(c).alias(f"{n}|distinct"))
        value = c
        if isinstance(field.dataType, T.NumericType):
            wanted += [
                F.avg(c.cast("double")).alias(f"{n}|mean"),
                F.stddev_pop(c.cast("double")).alias(f"{n}|sd"),
            ]
        elif isinstance(field.dataType, T.StringType):
            wanted += [
                F.min(F.length(c)).alias(f"{n}|minlen"),
                F.max(F.length(c)).alias(f"{n}|maxlen"),
                F.avg(F.length(c)).alias(f"{n}|avglen"),
            ]
        else:
            value = c.cast("string")
        wanted += [F.min(value).alias(f"{n}|min"), F.max(value).alias(f"{n}|max")]
    if split:
        one = df.agg(*wanted).first().asDict() | df.agg(*distinct).first().asDict()
    else:
        one = df.agg(*wanted, *distinct).first().asDict()
    out = {}
    for field in df.schema:
        n = field.name
        mode = None
        if isinstance(field.dataType, T.NumericType):
            counts = df.filter(F.col(n).isNotNull()).groupBy(F.col(n).alias("v"))
            top = counts.agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "v").first()
            mode = None if top is None else str(top["v"])
        mean, sd, avglen = (one.get(f"{n}|{k}") for k in ("mean", "sd", "avglen"))
        low, high = one[f"{n}|min"], one[f"{n}|max"]
        out[n] = {
            "row_count": total,
            "null_count": total - one[f"{n}|filled"],
            "distinct_count": one[f"{n}|distinct"],
            "min_value": None if low is None else str(low),
            "max_value": None if high is None else str(high),
            "mean": None if mean is None else round(mean, 6),
            "stddev_pop": None if sd is None else round(sd, 6),
            "cv": round(sd / mean, 6) if mean else None,
            "numeric_mode": mode,
            "avg_length": None if avglen is None else round(avglen, 4),
        }
    return out
