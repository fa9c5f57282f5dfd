"""Fit a table to its fixed serving types and report what does not fit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    FloatType,
    StructField,
    StructType,
    VarcharType,
)

from pricetide.functions.numeric import round_half_up


def _fitted(df: DataFrame, field: StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, VarcharType):
        return value.cast("string")
    source = df.schema[field.name].dataType
    if isinstance(field.dataType, DecimalType) and isinstance(source, (DoubleType, FloatType)):
        value = round_half_up(value, field.dataType.scale)
    return value.try_cast(field.dataType)


def conform(df: DataFrame, schema: StructType, strict: bool = False) -> DataFrame:
    """Columns of ``schema`` in its order and types; what does not fit is null.

    Text keeps its full length; ``misfits`` reports it when it is too long. With
    ``strict`` a value that would become null stops the query that reads it, in the
    same pass; its text may still be too long.
    """

    def fitted(f: StructField) -> Column:
        value = _fitted(df, f)
        if strict:
            lost = F.col(f.name).isNotNull() & value.isNull()
            why = F.concat(F.lit(f"{f.name} does not fit: "), F.col(f.name).cast("string"))
            value = F.when(lost, F.raise_error(why).cast(value_type(f))).otherwise(value)
        return value.alias(f.name)

    return df.select(*[fitted(f) for f in schema.fields])


def value_type(field: StructField) -> str:
    """The type a fitted value has: varying texts are plain ones."""
    return "string" if isinstance(field.dataType, VarcharType) else field.dataType.simpleString()


def misfits(df: DataFrame, schema: StructType) -> DataFrame:
    """Per column: values lost by the cast and texts over the length, in one pass."""
    counters, pairs = [], []
    for f in schema.fields:
        lost = F.count_if(F.col(f.name).isNotNull() & _fitted(df, f).isNull())
        too_long = F.lit(0).cast("bigint")
        if isinstance(f.dataType, VarcharType):
            too_long = F.count_if(F.char_length(f.name) > f.dataType.length)
        counters.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                lost.alias("n_lost"),
                too_long.alias("n_too_long"),
            )
        )
    return df.agg(F.array(*counters).alias("columns")).select(F.inline("columns"))


def require_fit(df: DataFrame, schema: StructType) -> DataFrame:
    """``conform(df, schema)``; raises if a value would be lost or a text is too long."""
    found = misfits(df, schema).filter("n_lost + n_too_long > 0").collect()
    if found:
        raise ValueError(f"does not fit: {[row.asDict() for row in found]}")
    return conform(df, schema)
