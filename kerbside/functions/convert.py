"""Conversions between text feeds and typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ISO_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
SPARK_TYPES = {"string": "string", "double": "double", "timestamp": "timestamp"}


def from_text(name: str, kind: str, on_error: str = "raise") -> Column:
    """Text to a typed column. A malformed cell fails the job, or becomes NULL with on_error="null"."""
    if on_error not in ("raise", "null"):
        raise ValueError(f"on_error must be 'raise' or 'null', not {on_error!r}")
    text = F.col(name)
    lenient = on_error == "null"
    if kind == "double":
        return text.try_cast("double") if lenient else text.cast("double")
    if kind == "timestamp":
        return F.try_to_timestamp(text) if lenient else F.to_timestamp(text)
    return text


def as_text(df: DataFrame, name: str) -> Column:
    """A column of a table as text: times in ISO form, numbers in their shortest form, NULL stays NULL."""
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(F.col(name), ISO_TIME).alias(name)
    return F.col(name).cast("string").alias(name)


def to_text(df: DataFrame) -> DataFrame:
    """Every column as text."""
    return df.select(*[as_text(df, name) for name in df.columns])


def blank_to_null(text: Column, name: str) -> Column:
    return F.nullif(text, F.lit("")).alias(name)


def local_times(df: DataFrame) -> DataFrame:
    """Instants shown as UTC wall-clock times without a zone, for comparing with other engines."""
    return df.withColumns({
        f.name: F.col(f.name).cast("timestamp_ntz")
        for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)})
