"""Row-level parsing that keeps what it cannot parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegauge.functions.columns import col

ERRORS, RAW = "_errors", "_raw"
_CORRUPT = "_corrupt"


def parsed(
    df: DataFrame,
    casts: dict[str, str] | None = None,
    json: dict[str, str] | None = None,
    required: list[str] | None = None,
) -> DataFrame:
    """``df`` with typed columns, ``_errors`` and, for rows that have errors, the row as it came.

    ``casts`` maps columns to types, ``json`` maps columns to DDL schemas whose fields take the
    column's place as a struct; ``required`` columns must not be null. Each row comes out once: with
    an empty ``_errors`` and a null ``_raw`` where all of it could be read, else with a message per
    column that could not, and null there.
    """
    checks: list[Column] = []
    typed: dict[str, Column] = {}
    for name, kind in (casts or {}).items():
        typed[name] = col(name).try_cast(kind)
        failed = col(name).isNotNull() & typed[name].isNull()
        checks.append(F.when(failed, F.lit(f"{name}: not {kind}")))
    for name, schema in (json or {}).items():
        given = T._parse_datatype_string(schema)
        marked = T.StructType([*given.fields, T.StructField(_CORRUPT, T.StringType())])
        read = F.from_json(col(name), marked, {"columnNameOfCorruptRecord": _CORRUPT})
        # Texts that are empty or hold another kind of JSON are read as null.
        broken = col(name).isNotNull() & (read.isNull() | read[_CORRUPT].isNotNull())
        fields = F.struct(*[read[f.name].alias(f.name) for f in given])
        typed[name] = F.when(read.isNotNull() & read[_CORRUPT].isNull(), fields)
        checks.append(F.when(broken, F.lit(f"{name}: not {schema}")))
    for name in required or []:
        checks.append(F.when(col(name).isNull(), F.lit(f"{name}: missing")))
    errors = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    raw = F.struct(*[col(n) for n in df.columns])
    # One projection reads every expression; errors are named before the columns are replaced.
    return df.select(
        *[typed[n].alias(n) if n in typed else col(n) for n in df.columns],
        errors.alias(ERRORS),
        F.when(F.size(errors) > 0, raw).alias(RAW),
    )


def accepted(rows: DataFrame) -> DataFrame:
    return rows.filter(F.size(ERRORS) == 0).drop(ERRORS, RAW)


def rejected(rows: DataFrame) -> DataFrame:
    """The rows as they came, with what was wrong with them."""
    return rows.filter(F.size(ERRORS) > 0).select(f"{RAW}.*", ERRORS)


def error_counts(rows: DataFrame) -> DataFrame:
    """How often each error occurs."""
    return rows.select(F.explode(ERRORS).alias("error")).groupBy("error").agg(F.count(F.lit(1)).alias("n"))


def is_rejected() -> Column:
    return F.size(ERRORS) > 0
