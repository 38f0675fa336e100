"""Near-duplicate vectors by spherical k-means cells, compared by blocked cosine products within cells.

Vectors are compared only with those of the same label and dimension, in double precision; equal directions of a label
are one class with a number of copies, named by its smallest id and, since an id may come with several vectors, by its
`mark`, a hash of label and direction. Each label has cells, one for about CELL of its classes, but at most CENTRES in
all; their centres are fitted on at most SAMPLE classes of the label. A class has its home in the cell of the
nearest centre. It is a guest in every cell a with a smaller number than its home b for which

    y . (c_b - c_a) <= sqrt(2 - 2 * threshold) * |c_b - c_a|

since only then can a class at home in a be as near as the threshold. So homes are compared with homes and guests of
their cell, each pair once, and none is missed. Where a label's vectors are spread evenly in many dimensions, nearly
all classes become guests of nearly all cells, and the work is that of comparing all of a label. Cells are cut into
tiles, so a task holds two tiles whatever the size of a cell, and returns one row per class: its links by number of
copies, and the smallest class of its group there.

Vectors that are null, zero, or hold null or non-finite components, and those without label, have no links and are
their own component. Rows that repeat a vec_id with the same direction are copies of each other. A vec_id with several
directions counts the links of each row's own vector, and is in the component of all of them. A null vec_id has a null
component and is kept. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import components, map_batches, store, tiles

CELL, CENTRES, SAMPLE, ROUNDS = 2048, 16_384, 4096, 10
TILE = 1024
ROWS = 256
THRESHOLD = 0.93
KEYS = ["label", "dim"]
CLASS = ["node", "mark"]
# A hash range of this many numbers, of which a sample takes a part before it is sorted.
HASHES = 1 << 40


def directions(rows: DataFrame) -> DataFrame:
    """(vec_id, label, dim, unit): unit vectors as doubles, null where a vector has no direction."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        units, sizes = [], []
        for values in batch.column("embedding").to_pylist():
            unit = None
            if values and None not in values:
                vector = np.array(values, np.float64)
                largest = np.abs(vector).max()
                if 0 < largest < math.inf:  # false for NaN
                    vector = vector / largest + 0.0  # no negative zero, and no overflow of squares
                    unit = (vector / np.sqrt(vector @ vector)).tobytes()
            units.append(unit)
            sizes.append(len(values) if unit else None)
        return pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("label"),
                                           pa.array(sizes, pa.int32()), pa.array(units, pa.binary())],
                                          ["vec_id", "label", "dim", "unit"])
    return map_batches(rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding"), work,
                       "vec_id long, label long, dim int, unit binary")


def spherical_k_means(x: np.ndarray, k: int) -> np.ndarray:
    """Unit centres of k cells, beginning with every so many-th row of a sample."""
    centres = x[np.arange(k) * len(x) // k]
    for _ in range(ROUNDS):
        home = (x @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, x)
        norms = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(norms > 1e-9, sums / np.maximum(norms, 1e-9), centres)
    return centres


def fit_cells(classes: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Centres of all labels with more than CELL classes, at most CENTRES in all."""
    sizes = classes.groupBy(*KEYS).agg(F.count("*").alias("n"))
    total = sizes.agg(F.sum("n")).first()[0] or 0
    cell = max(CELL, math.ceil(total / CENTRES))
    # A label has one cell per `cell` classes, rounded down: CENTRES in all at most.
    large = sizes.filter(F.col("n") >= 2 * cell).withColumn("k", F.least(F.floor(F.col("n") / cell),
                                                                      F.lit(SAMPLE // 8)).cast("int"))
    # About twice the sample by a bound on the hash; only these are put in order, and no task holds a whole label.
    spot = F.pmod(F.xxhash64(*CLASS), F.lit(HASHES))
    place = F.row_number().over(Window.partitionBy(*KEYS).orderBy("spot", *CLASS))
    sample = (classes.join(F.broadcast(large), KEYS).withColumn("spot", spot)
              .filter(F.col("spot") < F.lit(2.0 * SAMPLE * HASHES) / F.col("n"))
              .withColumn("place", place).filter(F.col("place") <= SAMPLE).select(*KEYS, "k", "unit"))

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(b"".join(rows["unit"]), np.float64).reshape(len(rows), -1)
        centres = spherical_k_means(x, int(rows["k"].iloc[0]))
        return pd.DataFrame({"label": rows["label"].iloc[:1], "dim": rows["dim"].iloc[:1],
                             "centres": [centres.tobytes()]})
    found = sample.groupBy(*KEYS).applyInPandas(fit, "label long, dim int, centres binary").collect()
    return {(label, dim): np.frombuffer(centres, np.float64).reshape(-1, dim) for label, dim, centres in found}


def place_in_cells(classes: DataFrame, cells: dict[tuple[int, int], np.ndarray], threshold: float) -> DataFrame:
    """Each class once per cell where it is at home or a guest."""
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, cell, at_home = [], [], []
        keys = zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist())
        for i, (key, unit) in enumerate(zip(keys, batch.column("unit").to_pylist())):
            centres = cells.get(key)
            if centres is None:
                here, home = [0], 0
            else:
                near = centres @ np.frombuffer(unit, np.float64)
                home = int(near.argmax())
                apart = np.linalg.norm(centres[home] - centres[:home], axis=1)
                here = [*np.flatnonzero(near[home] - near[:home] <= reach * apart + 1e-9).tolist(), home]
            row += [i] * len(here)
            cell += here
            at_home += [c == home for c in here]
        taken = batch.take(pa.array(row, pa.int32()))
        return pa.RecordBatch.from_arrays([*taken.columns, pa.array(cell, pa.int32()), pa.array(at_home, pa.bool_())],
                                          [*taken.schema.names, "cell", "at_home"])
    return map_batches(classes, work, "label long, dim int, node long, mark long, copies long, unit binary, "
                                      "cell int, at_home boolean")


def _compare(placed: DataFrame, threshold: float) -> DataFrame:
    """(node, mark, n_links, root): links found in a tile pair, and the smallest class connected there."""
    def work(rows: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(b"".join(rows["unit"]), np.float64).reshape(len(rows), -1)
        node, copies = rows["node"].to_numpy(), rows["copies"].to_numpy()
        home, tile = rows["at_home"].to_numpy(), rows["tile"].to_numpy()
        across = rows["tile_a"].iloc[0] != rows["tile_b"].iloc[0]
        near = np.zeros((len(x), len(x)), bool)
        for at in range(0, len(x), ROWS):
            part = slice(at, at + ROWS)
            found = x[part] @ x.T >= threshold
            found &= home[part, None] | home
            if across:
                found &= tile[part, None] != tile
            near[part] = found
        near |= near.T  # a product may differ in its last bit from that of the other order
        np.fill_diagonal(near, False)
        n_links = near @ copies
        some = np.flatnonzero(near.any(1))
        near, root = near[np.ix_(some, some)], node[some]
        while len(some):
            lower = np.minimum(root, np.where(near, root, np.iinfo(np.int64).max).min(1))
            if (lower == root).all():
                break
            root = lower
        return pd.DataFrame({"node": node[some], "mark": rows["mark"].to_numpy()[some], "n_links": n_links[some],
                             "root": root})
    return (tiles(placed, [*KEYS, "cell"], "mark", TILE).groupBy(*KEYS, "cell", "tile_a", "tile_b")
            .applyInPandas(work, "node long, mark long, n_links long, root long"))


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of a frame with columns vec_id, embedding and label."""
    vectors = store(directions(rows), "directions")
    usable = vectors.filter("unit is not null and label is not null")
    classes = usable.groupBy(*KEYS, "unit").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
    mark = F.xxhash64("unit", "label")
    # A class of rows without id has a name of its own that no component can take over.
    named = F.coalesce("least", F.lit(1 << 62) + F.pmod(mark, F.lit(1 << 61)))
    classes = store(classes.select(*KEYS, named.alias("node"), mark.alias("mark"), "copies", "unit"), "vector-classes")
    placed = place_in_cells(classes, fit_cells(classes), threshold)
    found = store(_compare(placed, threshold), "vector-links")
    joined = found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionAll(_one_id(usable, classes))
    component = components(joined, "vectors")
    links = found.groupBy(*CLASS).agg(F.sum("n_links").alias("n_links"))
    told = (classes.join(links, CLASS, "left").join(component, "node", "left")
            .withColumn("component", F.coalesce("component", "node"))
            .filter("copies > 1 or n_links > 0 or component <> node")
            .select(*KEYS, "unit", (F.coalesce("n_links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                    F.col("component").alias("class_component")))
    whole = vectors.join(told, [*KEYS, "unit"], "left")
    own = F.when(F.col("vec_id").isNotNull(), F.coalesce("class_component", "vec_id"))
    return whole.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                        own.alias("component_id"), F.coalesce(own == F.col("vec_id"), F.lit(True)).alias("kept"))


def _one_id(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between classes that hold different vectors of one vec_id: of each, with the smallest one."""
    named = usable.filter("vec_id is not null")
    direction = F.xxhash64("unit", "label")
    several = (named.groupBy("vec_id").agg(F.min(direction).alias("low"), F.max(direction).alias("high"))
               .filter("low <> high").select("vec_id"))
    held = (named.join(several, "vec_id").select("vec_id", *KEYS, "unit").distinct()
            .join(classes.select(*KEYS, "unit", "node"), [*KEYS, "unit"]).select("vec_id", "node"))
    smallest = held.groupBy("vec_id").agg(F.min("node").alias("least"))
    return (held.join(smallest, "vec_id").filter("node <> least")
            .select(F.col("node").alias("a"), F.col("least").alias("b")).distinct())
