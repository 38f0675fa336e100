"""Updates, deletes and comparisons of keyed tables, as DataFrame to DataFrame steps."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.functions.pricing import completion_fare

# A side of at most this many narrow rows may be sent to every executor.
BROADCAST_ROWS = 100_000


class SchemaMismatch(ValueError):
    """Rows to be written do not have the columns and types of the table."""


def open_ride_updates(rides: DataFrame, n: int = 500, finished_at: Column | None = None) -> DataFrame:
    """The first n open rides (by id), closed: completed, with a fare and a dropoff time."""
    finished_at = F.current_timestamp() if finished_at is None else finished_at
    return (rides.filter(F.col("ride_status") == "in_progress")
            .orderBy("ride_id").limit(n)
            .withColumns({
                "ride_status": F.lit("completed"),
                "fare_amount": completion_fare(F.col("distance_miles")),
                "dropoff_time": finished_at,
            }))


def unique_updates(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str],
                   source_rows: int | None = None, how: str = "inner") -> tuple[DataFrame, Callable[[str], Column]]:
    """Target rows joined with the source row of the same keys, and what each column of theirs becomes.

    A target row that meets several source rows fails the job, because it would not be clear which one to take.
    `source_rows` is an upper bound on the source that its maker keeps, such as a limit: up to BROADCAST_ROWS the
    source is cut there, one row beyond failing the job, and broadcast, so that the target is not shuffled. Without it
    Spark chooses the join by measured sizes, and cuts up partitions that one key makes too large.
    """
    one_per_key = source.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(f"_new_{c}") for c in columns])
    if source_rows is not None and source_rows <= BROADCAST_ROWS:
        place = F.row_number().over(Window.orderBy(F.lit(1)))
        bounded = one_per_key.limit(source_rows + 1).withColumn("_place", place)
        too_many = F.raise_error(F.lit(f"merge: the source has more than {source_rows} keys")).cast("int")
        one_per_key = F.broadcast(bounded.withColumn(
            "_n", F.when(F.col("_place") > source_rows, too_many).otherwise(F.col("_n"))).drop("_place"))
    types = {f.name: f.dataType for f in target.schema.fields}
    ambiguous = F.raise_error(F.lit("merge: several source rows match one target row"))

    def updated(name: str) -> Column:
        if name not in columns:
            return F.col(name)
        return (F.when(F.col("_n").isNull(), F.col(name))
                .when(F.col("_n") == 1, F.col(f"_new_{name}").cast(types[name]))
                .otherwise(ambiguous.cast(types[name])).alias(name))

    return target.join(one_per_key, list(keys), how), updated


def merge_update(target: DataFrame, source: DataFrame, keys: Sequence[str], columns: Sequence[str],
                 source_rows: int | None = None) -> DataFrame:
    """Target rows, with `columns` taken from the source row of the same keys where there is one.

    Source rows without a target row are ignored. See `unique_updates` for several of them and for `source_rows`.
    """
    matched, updated = unique_updates(target, source, keys, columns, source_rows, "left")
    return matched.select(*[updated(c) for c in target.columns])


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true; where it is NULL the row stays."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def first_driver(df: DataFrame) -> Column:
    """The smallest driver id of a table, as a value other queries can compare with."""
    return df.select(F.min("driver_id")).scalar()


def count_both(before: DataFrame, after: DataFrame, condition: Column, names: Sequence[str]) -> DataFrame:
    """One row: matches in `before`, matches in `after`, and the difference."""
    first, second, difference = names
    hits = (before.filter(condition).select(F.lit(True).alias("is_before"))
            .unionByName(after.filter(condition).select(F.lit(False).alias("is_before"))))
    return hits.agg(
        F.count_if("is_before").alias(first),
        F.count_if(~F.col("is_before")).alias(second),
    ).withColumn(difference, F.col(first) - F.col(second))


def delete_audit(before: DataFrame, after: DataFrame, condition: Column) -> DataFrame:
    return count_both(before, after, condition, ("n_before", "n_after", "n_deleted"))


def compare_open_rides(old: DataFrame, new: DataFrame) -> DataFrame:
    """Open rides in two versions of the rides table."""
    return count_both(old, new, F.col("ride_status") == "in_progress",
                      ("in_progress_then", "in_progress_now", "n_updated"))


def change_feed(old: DataFrame, new: DataFrame, key: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Keys inserted, updated or deleted between two versions, with the old and new value of `columns`.

    Rows are compared value by value, NULLs included, over all columns of the table; `columns` only
    chooses what is shown. The key may be NULL, as long as it is unique.
    """
    compared = [c for c in new.columns if c != key]
    shown = compared if columns is None else list(columns)
    before = old.select(F.col(key).alias("_old_key"), F.struct(*compared).alias("_old"))
    after = new.select(F.col(key).alias("_new_key"), F.struct(*compared).alias("_new"))
    pairs = before.join(after, F.col("_old_key").eqNullSafe(F.col("_new_key")), "full_outer")
    return change_kind(pairs.select(F.coalesce("_new_key", "_old_key").alias("key"), F.col("_old").alias("old"),
                                    F.col("_new").alias("new")), key, shown)


def change_kind(pairs: DataFrame, key: str, shown: Sequence[str]) -> DataFrame:
    """Changes out of (key, old, new), the row's values before and after; a row that was or is not there is NULL."""
    change = (F.when(F.col("old").isNull() & F.col("new").isNull(), None)
              .when(F.col("old").isNull(), "insert")
              .when(F.col("new").isNull(), "delete")
              .when(~F.col("old").eqNullSafe(F.col("new")), "update"))
    return pairs.withColumn("change", change).filter(F.col("change").isNotNull()).select(
        F.col("key").alias(key),
        "change",
        *[F.col(f"old.{c}").alias(f"old_{c}") for c in shown],
        *[F.col(f"new.{c}").alias(f"new_{c}") for c in shown],
    )


def conform(df: DataFrame, like: DataFrame) -> DataFrame:
    """The rows in the column order of `like`, or SchemaMismatch if names or types differ."""
    wanted = {f.name: f.dataType for f in like.schema.fields}
    given = {f.name: f.dataType for f in df.schema.fields}
    problems = [f"missing column {c}" for c in wanted if c not in given]
    problems += [f"unknown column {c}" for c in given if c not in wanted]
    problems += [f"{c} is {given[c].simpleString()}, not {t.simpleString()}"
                 for c, t in wanted.items() if c in given and given[c] != t]
    if problems:
        raise SchemaMismatch("; ".join(problems))
    return df.select(*wanted)
