"""Keyed tables with versions, kept as ordinary Parquet folders.

A load writes all rows, by partition, below `data/version=<version>/`. An update or delete writes only the rows that it
changes, each with its old and its new values, below `changes/version=<version>/`, so its cost is that of the change
and not of the table. Reading lays the newest change of each key over the last load; the change feed between two
versions without a load in between reads the changes alone. `overwrite(read())` folds them into a new load.

A version exists once its row is in the history table: a job that dies half way leaves files that no reader looks at
and that the next change with that number replaces. One writer at a time.

The history row of a version names the folders that hold the changes since its load, and the partition values that these
have touched. So a read joins with the changes only those folders of the load that they name; the others pass as they are.
Once FOLD folders of one level have come together, the next change puts their rows, which bear their version, into one
folder of the next level: the list stays short, every version stays readable, and a row is written again as often as the
logarithm of the number of changes. Readers go by the newest row's list and so never see rows twice. Folders that a fold has
replaced are removed by the next fold, which leaves time to readers that have listed them. The history table itself is
folded likewise: every FOLD versions a new generation begins with all rows so far, and readers look at the newest one.

Partition values must not be empty strings, which folders cannot tell from NULL; writing one fails the job.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kerbside.operators.changes import change_feed, change_kind, conform, unique_updates
from kerbside.sources.files import remove, scan_or_empty, write_table

FOLD = 10

HISTORY = T.StructType([
    T.StructField("version", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("operation", T.StringType()),
    T.StructField("operationParameters", T.MapType(T.StringType(), T.StringType())),
    T.StructField("n_rows_written", T.LongType()),
    T.StructField("is_load", T.BooleanType()),
    T.StructField("schema", T.StringType()),                            # of a load
    T.StructField("rests_on", T.LongType()),                            # the load's version
    T.StructField("folders", T.ArrayType(T.StringType())),              # of changes since the load
    T.StructField("retired", T.ArrayType(T.StringType())),              # replaced by the last fold
    T.StructField("touched", T.ArrayType(T.StringType())),              # partition values changed since the load
])
SHOWN = HISTORY.names[:6]
STORED_HISTORY = T.StructType([*HISTORY.fields, T.StructField("generation", T.LongType())])


class KeyedTable:
    def __init__(self, spark: SparkSession, path: str, key: str, partition: str):
        self.spark = spark
        self.path = path
        self.key = key
        self.partition = partition

    # -- reading ---------------------------------------------------------------------------------

    def history(self, n: int | None = None) -> DataFrame:
        """Versions, latest first: number, commit time, operation and its parameters."""
        rows = self._history().select(*SHOWN).orderBy(F.col("version").desc())
        return rows if n is None else rows.limit(n)

    def exists(self) -> bool:
        return not self._history().isEmpty()

    def version_at(self, time: datetime) -> int:
        """The version that was current at the given time."""
        version = self._history().filter(F.col("timestamp") <= F.lit(time)).agg(F.max("version")).first()[0]
        if version is None:
            raise ValueError(f"{self.path} has no version at {time}")
        return version

    def read(self, version: int | None = None) -> DataFrame:
        """The table as of a version, by default the newest. Partitions without a change pass without a join."""
        state = self._state(version)
        rows = self._load(state)
        if state["version"] == state["rests_on"]:
            return rows
        newest = self._newest(state, state["rests_on"], state["version"])
        changed = newest.select(F.col("key").alias("_changed"))
        touched = self._within(state["touched"])
        kept = rows.filter(touched).join(changed, F.col(self.key).eqNullSafe(F.col("_changed")), "left_anti")
        new = newest.filter(F.col("new").isNotNull()).select("new.*").select(*rows.columns)
        return rows.filter(~touched).unionByName(kept).unionByName(new)

    def read_as_of(self, time: datetime) -> DataFrame:
        return self.read(self.version_at(time))

    def changes(self, since: int, until: int | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """Rows inserted, updated or deleted between two versions: the net change of each key.

        Reads only what the versions in between have written, unless one of them loads the table anew; then the
        two versions are compared, partition by partition first, and row by row only where partitions differ.
        """
        old, new = self._state(since), self._state(until)
        if old["rests_on"] != new["rests_on"]:
            then, now = self.read(since), self.read(until)
            differing = self._within(differing_values(then, now, self.partition))
            return change_feed(then.filter(differing), now.filter(differing), self.key, columns)
        compared = [c for c in self._schema(new).names if c != self.key]
        if old["version"] == new["version"]:
            return change_feed(self.read(since).limit(0), self.read(since).limit(0), self.key, columns)
        net = self._newest(new, old["version"], new["version"])
        net = net.select("key", *[F.when(F.col(c).isNotNull(), F.struct(*[f"{c}.{name}" for name in compared])).alias(c)
                                  for c in ("old", "new")])
        return change_kind(net, self.key, list(columns) if columns is not None else compared)

    # -- writing ---------------------------------------------------------------------------------

    def overwrite(self, df: DataFrame) -> int:
        """Replace all rows (the first load, or a reload) and return the new version.

        A reload must have the columns and types of the table, in any order; else SchemaMismatch is raised
        and the table stays as it is.
        """
        newest = self._history().agg(F.max("version")).first()[0]
        if newest is not None:
            df = conform(df, self.read())
        version = 0 if newest is None else newest + 1
        # Folder columns come back last, so the table's column order is fixed that way from the start.
        rows = df.select(*[c for c in df.columns if c != self.partition], self._partition_value(df))
        n = write_table(rows, f"{self.path}/data/version={version}", self.partition)
        self._commit(version, "WRITE", {"mode": "Overwrite", "partitionBy": self.partition}, n, version, [], [], [],
                     rows.schema.json())
        return version

    def merge(self, source: DataFrame, keys: Sequence[str], columns: Sequence[str],
              source_rows: int | None = None) -> int | None:
        """Update `columns` of matching rows. Returns the new version, or None if nothing matches.

        Source rows without a target row are ignored; a target row that meets several source rows fails the job.
        """
        state = self._state()
        current = self.read()
        matched, updated = unique_updates(current, source, keys, columns, source_rows)
        new = F.struct(*[updated(c) for c in current.columns])
        rows = matched.select(F.struct(*current.columns).alias("old"), new.alias("new"))
        return self._change(state, rows, "MERGE", {"predicate": json.dumps(list(keys))})

    def delete(self, condition: Column, description: str = "") -> int | None:
        """Delete the rows for which the condition is true. Returns the new version, or None if there are none."""
        state = self._state()
        gone = self.read().filter(condition)
        row = F.struct(*gone.columns)
        rows = gone.select(row.alias("old"), F.when(F.lit(False), row).alias("new"))
        return self._change(state, rows, "DELETE", {"predicate": description})

    # -- internals -------------------------------------------------------------------------------

    def _history(self) -> DataFrame:
        """Rows of the newest generation that is there."""
        rows = scan_or_empty(self.spark, f"{self.path}/history", STORED_HISTORY)
        return rows.filter(F.col("generation") == rows.select(F.max("generation")).scalar()).drop("generation")

    def _state(self, version: int | None = None) -> Row:
        """A version, by default the newest, the load it rests on, and where the changes since then are: one row, worked
        out by Spark. Folders are those of the newest version on that load, which hold the rows of all before it."""
        rows = self._history()
        asked = F.lit(True) if version is None else F.col("version") <= version
        same_load = F.col("rests_on") == rows.filter(asked).select(F.max("rests_on")).scalar()
        state = rows.filter(same_load).agg(
            F.max(F.when(asked, F.col("version"))).alias("version"), F.max("rests_on").alias("rests_on"),
            F.max("schema").alias("schema"),
            *[F.max_by(c, "version").alias(c) for c in ("folders", "retired", "touched")]).first()
        if state["version"] is None or version is not None and state["version"] != version:
            raise ValueError(f"{self.path} has no version" + ("" if version is None else f" {version}"))
        return state

    def _schema(self, state: Row) -> T.StructType:
        return T.StructType.fromJson(json.loads(state["schema"]))

    def _load(self, state: Row) -> DataFrame:
        return self.spark.read.schema(self._schema(state)).parquet(f"{self.path}/data/version={state['rests_on']}")

    def _within(self, values: Sequence[str | None]) -> Column:
        """Rows of these partitions; a condition on the folder column alone, so that other folders are not read."""
        named = F.col(self.partition).cast("string").isin([v for v in values if v is not None])
        missing = F.col(self.partition).isNull() if None in values else F.lit(False)
        return F.coalesce(named, F.lit(False)) | missing

    def _change_rows(self, folders: Sequence[str]) -> DataFrame:
        """(version, old, new) out of folders of changes; a deleted row has no new values."""
        return self.spark.read.parquet(*[f"{self.path}/changes/{folder}" for folder in folders])

    def _newest(self, state: Row, after: int, until: int) -> DataFrame:
        """(key, old, new) of each key changed in these versions: as it was before them, and after."""
        rows = self._change_rows(state["folders"]).filter((F.col("version") > after) & (F.col("version") <= until))
        # A deleted row has no new values; min_by and max_by would not skip the NULL if it were not in a struct.
        found = rows.groupBy(F.col(f"old.{self.key}").alias("key")).agg(
            F.min_by(F.struct("old"), "version")["old"].alias("old"),
            F.max_by(F.struct("new"), "version")["new"].alias("new"))
        return found

    def _partition_value(self, df: DataFrame) -> Column:
        value = F.col(self.partition)
        if df.schema[self.partition].dataType != T.StringType():
            return value
        empty = F.raise_error(F.lit(f"{self.partition} is an empty string"))
        return F.when(value == "", empty.cast("string")).otherwise(value).alias(self.partition)

    def _change(self, state: Row, rows: DataFrame, operation: str, parameters: dict) -> int | None:
        version = state["version"] + 1
        own = f"version={version}"
        n = write_table(rows.withColumn("version", F.lit(version).cast("long")), f"{self.path}/changes/{own}")
        if not n:
            return None
        # At most one value per folder of the table.
        value = F.col(f"old.{self.partition}").cast("string")
        touched = [r[0] for r in self._change_rows([own]).select(value).distinct().collect()]
        touched = list(dict.fromkeys([*state["touched"], *touched]))
        folders, replaced = folded([*state["folders"], own], version)
        if replaced:
            write_table(self._change_rows(replaced), f"{self.path}/changes/{folders[-1]}")
        self._commit(version, operation, parameters, n, state["rests_on"], folders, replaced or state["retired"], touched)
        if replaced:
            for folder in state["retired"]:
                remove(self.spark, f"{self.path}/changes/{folder}")
        return version

    def _commit(self, version: int, operation: str, parameters: dict, n: int, rests_on: int, folders: list[str],
                retired: list[str], touched: list[str | None], schema: str | None = None) -> None:
        entry = (version, datetime.now(timezone.utc), operation, parameters, n, schema is not None, schema, rests_on,
                 folders, retired, touched)
        rows = self.spark.createDataFrame([entry], HISTORY)
        generation, begins = version // FOLD, version % FOLD == 0
        if begins and version:
            rows = self._history().unionByName(rows)
        rows.coalesce(1).write.mode("overwrite" if begins else "append").parquet(
            f"{self.path}/history/generation={generation}")
        if begins and generation > 1:
            remove(self.spark, f"{self.path}/history/generation={generation - 2}")


def folded(folders: list[str], version: int) -> tuple[list[str], list[str]]:
    """The list of folders after a change, and those that one new folder (the last of the list) replaces, if any.

    FOLD folders of one level at the list's end become one of the next; that may complete a level there.
    """
    kept, replaced, level = list(folders), [], 0
    while len(last := [f for f in kept if _level(f) == level]) + bool(replaced) >= FOLD:
        kept, replaced, level = [f for f in kept if _level(f) != level], [*last, *replaced], level + 1
    return (kept + [f"level={level},version={version}"], replaced) if replaced else (kept, [])


def _level(folder: str) -> int:
    return int(folder.split(",")[0].removeprefix("level=")) if folder.startswith("level=") else 0


def differing_values(then: DataFrame, now: DataFrame, partition: str) -> list[str | None]:
    """Partition values in which two versions differ, by the number of rows and two sums of their hashes.

    Reads both once and shuffles one row per partition and task. Partitions that differ are taken for equal with a chance
    below 2^-64. At most one value per folder comes to the driver.
    """
    columns = [F.col(c) for c in then.columns]
    sums = [F.count("*").alias("n"), F.sum(F.hash(*columns).cast("long")).alias("low"),
            F.bit_xor(F.xxhash64(*columns)).alias("high")]

    def digests(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy(F.col(partition).cast("string").alias("value")).agg(F.struct(*sums).alias(name))
    both = digests(then, "then").join(digests(now.select(*then.columns), "now").withColumnRenamed("value", "other"),
                                      F.col("value").eqNullSafe(F.col("other")), "full_outer")
    differ = both.filter(~F.col("then").eqNullSafe(F.col("now")))
    there = F.when(F.col("then").isNull(), F.col("other")).otherwise(F.col("value"))
    return [r[0] for r in differ.select(there).collect()]
