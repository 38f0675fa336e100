"""Row counts per table and checks that tables are there and not empty."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.operators.gold import GOLD
from kerbside.schemas import FEEDS
from kerbside.sources.files import path_exists, read_csv, union_all


class MissingData(RuntimeError):
    """Tables that are missing or empty."""


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    return union_all(
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table"), "n_rows")
        for name, df in tables.items())


def with_status(counts: DataFrame) -> DataFrame:
    return counts.withColumn("status", F.when(F.col("n_rows") > 0, "ok").otherwise("empty"))


def check_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count and status of each table."""
    return with_status(table_counts(tables))


def require(found: Mapping[str, DataFrame | None]) -> list[str]:
    """Names of the tables if all exist and have a row; otherwise MissingData names those that do not.

    Only the first row of each table is looked for, so no table is read whole.
    """
    missing = [name for name, df in found.items() if df is None]
    empty = [name for name, df in found.items() if df is not None and df.isEmpty()]
    if missing or empty:
        raise MissingData("; ".join([f"{n}: missing" for n in missing] + [f"{n}: empty" for n in empty]))
    return list(found)


def validate_inputs(spark: SparkSession, input_dir: str) -> list[str]:
    """The four feed files exist and hold a data row."""
    paths = {name: f"{input_dir}/{name}.csv" for name in FEEDS}
    return require({n: read_csv(spark, p) if path_exists(spark, p) else None for n, p in paths.items()})


def validate_outputs(spark: SparkSession, warehouse: str) -> list[str]:
    """The five report tables exist and hold a row."""
    paths = {name: f"{warehouse}/gold/{name}" for name in GOLD}
    return require({n: spark.read.parquet(p) if path_exists(spark, p) else None for n, p in paths.items()})
