"""What the operators share: stored steps, Arrow mapping, connected components, split groups."""

from __future__ import annotations

import os
import shutil
import tempfile
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kerbside.session import working_folder

# Rows of a batch that goes to Python: long texts must not add up to more than a task can hold.
BATCH_ROWS = 500
BATCH_BYTES = "16m"
WHITE = b"\t\n\x0b\x0c\r "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Write a step below the cluster's shared folder and read it back: what follows does not depend on executors."""
    folder = working_folder(df.sparkSession, f"llm-{label}")
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the session's Python workers, wherever the driver imported it from, and bound what a
    batch brings them."""
    # Long texts make large batches: they are cut by size too, so that a worker's memory does not follow the texts.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        made = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="kerbside-"), "kerbside"), "zip",
                                   os.path.dirname(package), os.path.basename(package))
        context.addPyFile(made)
        _SHIPPED.add(context.applicationId)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def map_batches(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """One Arrow batch in, one out, with no shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                yield work(batch.slice(at, BATCH_ROWS))
    return map_arrow(df, run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch, null as empty."""
    return [text or "" for text in batch.column(column).to_pylist()]


def id_checksum(column: str = "doc_id") -> Column:
    """crc32 of an id written as decimal text; NULL for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def checksum(value: int | None) -> int:
    return zlib.crc32(b"" if value is None else str(value).encode())


def words_of(text: str) -> list[bytes]:
    """Runs of bytes other than the six ASCII white-space characters, A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


# -- places in an order ------------------------------------------------------------------------------

PLACE_BITS = 33


def key_of(column: str) -> Column:
    """A column as text that is never null: empty for a null, else `=` and the value."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def in_order(rows: DataFrame, group: str, order: list[Column | str], label: str, weight: str | None = None,
             most_rows: int = 0, most_weight: int = 0) -> DataFrame:
    """Rows as stored in order of group and `order`, with `place`, their place in the whole table, and `begin`, the place
    of the first row of their group in the same range; with `weight`, of the first row of a run of such rows.

    Rows are dealt by ranges of that order, so a group of any size is spread over tasks, and each task counts its own
    rows. A run ends after `most_rows` rows, or once its rows' weights come to `most_weight`. `group` is not null.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = TaskContext.get().partitionId() << PLACE_BITS
        before, begin, total = None, place, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            groups = batch.column(group)
            codes = np.asarray(groups.dictionary_encode().indices)
            starts = np.append(groups[0].as_py() != before, codes[1:] != codes[:-1])
            here = place + np.arange(len(codes), dtype=np.int64)
            if weight:
                at, first = begin, place
                for k, own in enumerate(batch.column(weight).to_pylist()):
                    if starts[k] or total >= most_weight or first + k - at >= most_rows:
                        starts[k], at, total = True, first + k, 0
                    total += own
            begins = np.maximum.accumulate(np.where(starts, here, begin))
            before, begin, place = groups[-1].as_py(), int(begins[-1]), place + len(codes)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(here), pa.array(begins)],
                                             [*batch.schema.names, "place", "begin"])

    ordered = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return store(map_arrow(ordered, run, f"{fields}, place long, begin long"), label)


def numbered(rows: DataFrame, group: str, order: list[Column | str], label: str) -> DataFrame:
    """Rows with `index`, their place in their group from 0.

    A group that began in an earlier range adds its rows there. Only the first group of a range can have done so: that
    table has at most one row for each range, and is sent to all tasks.
    """
    stored = in_order(rows, group, order, label)
    part = F.shiftright("place", PLACE_BITS).alias("part")
    earlier = Window.partitionBy(group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = (stored.groupBy(group, part).agg(F.count("*").alias("n"))
             .select(group, "part", F.sum("n").over(earlier).alias("earlier")).filter("earlier > 0"))
    found = stored.withColumn("part", part).join(F.broadcast(spans), [group, "part"], "left")
    index = F.col("place") - F.col("begin") + F.coalesce("earlier", F.lit(0))
    return found.select(*rows.columns, index.alias("index"))


# -- connected components ----------------------------------------------------------------------------

def components(links: DataFrame, label: str) -> DataFrame:
    """(node, component) of every linked node; component is the smallest node reachable.

    `links` has long columns a and b. Large-star and small-star steps alternate until nothing changes: each
    is an aggregate and a join on one node, so a node with very many links is pre-aggregated and split.
    The state between rounds is a stored table; only its row count and checksum come to the driver.
    """
    edges = store(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                  .filter("a <> b").distinct(), f"{label}-links")
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Every edge now goes from a larger to a smaller node.
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = store(small.unionAll(low.select("a", F.col("m").alias("b"))).filter("a <> b")
                      .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
                      f"{label}-round")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_000_007)).first()
        if state == before:
            break
        before = state
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


# -- groups too large for one task -------------------------------------------------------------------

# Keys with this share of all rows, or more, are heavy: there are at most so many of them.
HEAVY = 1000


def meet(rows: DataFrame, nodes: DataFrame, keys: list[str], weight: str, total: int) -> DataFrame:
    """Inner join of rows with one node per key, for keys that may hold any share of the rows.

    `weight` counts a node's rows, of which there are at most `total`: nodes with one in HEAVY of them or more, at most
    HEAVY nodes, are sent to all tasks, so that their rows stay where they are; the others are joined by their keys.
    """
    heavy = F.col(weight) * HEAVY >= total
    known = F.broadcast(nodes.filter(heavy))
    light = rows.join(F.broadcast(nodes.filter(heavy).select(*keys)), keys, "left_anti")
    return rows.join(known, keys).unionByName(light.join(nodes.filter(~heavy), keys))


def tiles(members: DataFrame, keys: list[str], spread: str, size: int, total: int | None = None) -> DataFrame:
    """Split each group into tiles of about `size` rows and send each tile to every pairing with another one.

    A group of n rows becomes about (n/size)^2/2 bounded groups (keys, tile_a, tile_b), which together hold every
    pair of its members at least once; `tile` says which tile a row is of. Groups of up to `size` rows stay whole.
    With `total`, a bound on all rows, large groups learn their size by broadcast.
    """
    sizes = members.groupBy(*keys).agg(F.ceil(F.count("*") / size).cast("int").alias("n_tiles"),
                                       F.count("*").alias("in_group"))
    sized = members.join(sizes, keys) if total is None else meet(members, sizes, keys, "in_group", total)
    placed = sized.drop("in_group").withColumn(
        "tile", F.pmod(F.xxhash64(F.col(spread), F.lit(7)), F.col("n_tiles")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("n_tiles") - 1))
    return (placed.withColumn("other", other)
            .withColumn("tile_a", F.least("tile", "other")).withColumn("tile_b", F.greatest("tile", "other"))
            .drop("other", "n_tiles"))
