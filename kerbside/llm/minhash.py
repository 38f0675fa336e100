"""Near-duplicate documents by bottom-k sketches of one hash function, confirmed on full shingle sets.

A document is the set of its distinct shingles, `width` consecutive words; one of fewer words is one shingle, and one
without words has an empty set and is linked with nothing. Shingles are named by 64-bit hashes. Two documents are
linked if |A and B| >= threshold * |A or B|; groups are the connected components of links.

1. Documents with equal sets (by size and two independent sums over the set) are one class, named by its smallest id
   and, since an id may come with several texts, by its `mark`, a hash of the size and sums.
2. A class keeps its SKETCH smallest hashes. Linked classes share at least `required` of them: exactly so where the
   sketch holds the whole set, else but for a chance below RISK for each pair, as each of the SKETCH smallest
   values of the union is shared with a chance of threshold or more. Retained values are ordered from rare to frequent; linked
   classes then share one of the first |sketch| - required + 1, so only those enter the inverted lists, and
   passages that many documents share stay out.
3. Each list elects as hub its class with the fewest unshared values, and only pairs with a hub are compared: first
   by the estimate from the sketch of the union, then on full sets.
4. Lists that still hold several components, hub left aside, are compared within: their classes' full sets come
   together in bounded tiles, where sizes and, unless they leave most pairs, sketches (of which linked classes share
   `required` values) decide which pairs are looked at, and links between classes that are not connected yet come out. So the pairs of a
   large group are neither shuffled nor returned, and no link that would join two components is missed.

Lists with one in HEAVY of all retained values or more (common.py) meet their hub by broadcast, the others by a join.

Rows that repeat a doc_id with the same text count as copies of it. A doc_id with several texts is one document that has
them all: what any of them is linked with is in its component; only rows without words stay by themselves, under
their own id. Rows without doc_id get no component of their own (component_id is null) and are kept. Ties of hubs go to the smaller id. Null text is empty. Other columns are not read.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import components, map_batches, meet, store, texts_of, tiles, words_of

SKETCH = 64
RISK = 1e-9
# Classes of a list that are compared in one task.
TILE = 1024
# Bits of the filter by which documents without any candidate are kept from the second pass.
FILTER_BITS = 1 << 22
WORDS = 150_000
THRESHOLD = 0.8
SIGNATURE = ["n", "sum_a", "sum_b"]
CLASS = ["node", "mark"]

_MIX = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        found = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = found
        return found


WORD_HASHES = _WordHashes()


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted names of the distinct shingles of a text."""
    words = words_of(text)
    hashes = np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))
    span = max(1, min(width, len(hashes)))
    total = np.full(max(0, len(hashes) - span + 1), span, np.uint64)
    for k in range(span):
        total = total * _MIX[2] + mix(hashes[k:len(hashes) - span + 1 + k] + np.uint64(k))
    return np.unique(mix(total).view(np.int64))


@lru_cache(maxsize=None)
def sure(threshold: float) -> int:
    """The largest m such that fewer than m of SKETCH values, each shared with chance `threshold`, are shared with a
    chance below RISK."""
    chance = 0.0
    for m in range(SKETCH + 1):
        chance += math.comb(SKETCH, m) * threshold ** m * (1 - threshold) ** (SKETCH - m)
        if chance >= RISK:
            return m
    return SKETCH


def required(n: Column, threshold: float) -> Column:
    """Retained values that a class with n shingles shares with any linked class at least."""
    return F.least(F.ceil(n * F.lit(threshold) - 1e-9), F.lit(sure(threshold))).cast("int")


def _mark() -> Column:
    return F.xxhash64("n", "sum_a", "sum_b")


def _sums(sets: list[np.ndarray]) -> list[pa.Array]:
    """Size and two independent sums of each set."""
    return [pa.array([len(s) for s in sets], pa.int64()), pa.array([int(s.sum()) for s in sets], pa.int64()),
            pa.array([int(mix(s.view(np.uint64) * _MIX[3]).view(np.int64).sum()) for s in sets], pa.int64())]


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, sum_a, sum_b, sketch) of every document; the sums name the whole set."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(text, width) for text in texts_of(batch)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *_sums(sets), pa.array([s[:SKETCH] for s in sets], pa.list_(pa.int64()))],
            ["doc_id", "n", "sum_a", "sum_b", "sketch"])
    return map_batches(docs.select("doc_id", "text"), work,
                       "doc_id long, n long, sum_a long, sum_b long, sketch array<long>")


def _slot(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(FILTER_BITS))


def _filter_bits(ids: DataFrame) -> bytes:
    """A set of ids as FILTER_BITS bits, whatever their number; it may let others pass, which a join then drops."""
    words = (ids.select(_slot("node").alias("slot"))
             .select(F.shiftright("slot", 5).alias("word"), F.expr("shiftleft(1L, cast(slot & 31 as int))").alias("mask"))
             .groupBy("word").agg(F.bit_or("mask").alias("mask")).collect())
    found = np.zeros(FILTER_BITS // 32, "<u4")
    for word, mask in words:
        found[word] = mask
    return found.tobytes()


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(node, mark, shingles as sorted array) of the classes named in `ids`."""
    bits = _filter_bits(ids)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        table = np.frombuffer(bits, "<u4")
        at = batch.column("slot").to_numpy()
        batch = batch.filter(pa.array((table[at >> 5] >> (at & 31).astype("<u4") & 1).astype(bool)))
        sets = [shingles(text, width) for text in texts_of(batch)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *_sums(sets), pa.array(sets, pa.list_(pa.int64()))],
                                          ["node", "n", "sum_a", "sum_b", "shingles"])
    some = docs.filter("doc_id is not null").select("doc_id", "text", _slot("doc_id").alias("slot"))
    found = map_batches(some, work, "node long, n long, sum_a long, sum_b long, shingles array<long>")
    return (found.select("node", _mark().alias("mark"), "shingles").join(ids, CLASS, "left_semi").dropDuplicates(CLASS))


def _linked(common: Column, a: Column, b: Column, threshold: float) -> Column:
    """100 * common >= 100 threshold * size of the union, in whole numbers."""
    return 100 * common >= round(100 * threshold) * (a + b - common)


class _Overlaps:
    """Sizes of the overlaps of one set with others of a list of sets."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.start = np.r_[0, np.cumsum([len(s) for s in sets])]
        values, self.place = np.unique(np.concatenate(sets), return_inverse=True)
        self.mark = np.zeros(len(values), bool)

    def _of(self, i: int) -> np.ndarray:
        return self.place[self.start[i]:self.start[i + 1]]

    def all_later(self, i: int) -> np.ndarray:
        """With every set behind the i-th."""
        self.mark[self._of(i)] = True
        low = self.start[i + 1]
        found = np.add.reduceat(self.mark[self.place[low:]], self.start[i + 1:-1] - low, dtype=np.int64)
        self.mark[self._of(i)] = False
        return found

    def some(self, i: int, others: np.ndarray) -> np.ndarray:
        self.mark[self._of(i)] = True
        found = np.array([np.count_nonzero(self.mark[self._of(j)]) for j in others], np.int64)
        self.mark[self._of(i)] = False
        return found


def _compare(lists: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between classes of a tile pair that are in different components; enough of them to connect all
    that are linked."""
    percent = round(100 * threshold)

    def work(rows: pd.DataFrame) -> pd.DataFrame:
        first = int(rows["tile_a"].iloc[0])
        # The smaller components first: each class of the larger one is only looked at by those of smaller ones.
        rows = rows.assign(size=rows.groupby("component")["node"].transform("size")).sort_values(["size", *CLASS])
        sets, nodes, tile = rows["shingles"].tolist(), rows["node"].to_numpy(), rows["tile"].to_numpy()
        n = np.array([len(s) for s in sets])
        group = pd.factorize(rows["component"])[0]
        whole, short = _Overlaps(sets), _Overlaps([s[:SKETCH] for s in sets])
        least = np.minimum(np.ceil(n * threshold - 1e-9), sure(threshold))
        # Where sketches leave many pairs anyway, as among near copies, full sets are compared at once.
        same_tile, links, few = int(rows["tile_b"].iloc[0]) == first, [], True
        for i in range(len(rows) - 1):
            later = np.arange(i + 1, len(rows))
            later = later[(group[later] != group[i]) & (same_tile | (tile[later] != tile[i]))
                          & (100 * np.minimum(n[later], n[i]) >= percent * np.maximum(n[later], n[i]))]
            if few and len(later):
                close = later[short.all_later(i)[later - i - 1] >= np.maximum(least[i], least[later])]
                few = 8 * len(close) <= len(rows)
                later = close
            if not len(later):
                continue
            common = whole.some(i, later) if few else whole.all_later(i)[later - i - 1]
            for j in later[100 * common >= percent * (n[later] + n[i] - common)]:
                if group[j] != group[i]:
                    links.append((nodes[i], nodes[j]))
                    group[group == group[j]] = group[i]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")
    return lists.groupBy("v", "tile_a", "tile_b").applyInPandas(work, "a long, b long")


def _one_id(sketched: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) between classes that hold different texts of one doc_id: of each, with the smallest one."""
    texts = sketched.filter("n > 0 and doc_id is not null")
    several = (texts.groupBy("doc_id").agg(F.min(_mark()).alias("low"), F.max(_mark()).alias("high"))
               .filter("low <> high").select("doc_id"))
    held = (texts.join(several, "doc_id").select("doc_id", *SIGNATURE).distinct()
            .join(classes.select("node", *SIGNATURE), SIGNATURE).select("doc_id", "node"))
    smallest = held.groupBy("doc_id").agg(F.min("node").alias("least"))
    return (held.join(smallest, "doc_id").filter("node <> least")
            .select(F.col("node").alias("a"), F.col("least").alias("b")).distinct())


def near_duplicates(docs: DataFrame, width: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document."""
    sketched = store(sketches(docs, width), "sketches")
    classes = (sketched.filter("n > 0 and doc_id is not null").groupBy(*SIGNATURE)
               .agg(F.min("doc_id").alias("node"), F.count("*").alias("copies"), F.first("sketch").alias("sketch")))
    classes = store(classes.withColumn("mark", _mark()), "classes")

    # The first values of each sketch in order of frequency, among those that several classes retain.
    retained = classes.select(*CLASS, "n", F.explode("sketch").alias("v"))
    shared = retained.groupBy("v").agg(F.count("*").alias("df")).filter("df > 1")
    own = F.least("n", F.lit(SKETCH)).cast("int")
    ranked = (retained.join(shared, "v").groupBy(*CLASS, "n")
              .agg(F.sort_array(F.collect_list(F.struct("df", "v"))).alias("values"))
              .withColumn("unshared", own - F.size("values"))
              .withColumn("first", own - required(F.col("n"), threshold) + 1 - F.col("unshared"))
              .filter("first > 0"))
    lists = store(ranked.select(*CLASS, "n", "unshared",
                                F.explode(F.slice("values", 1, F.col("first"))["v"]).alias("v")), "lists")
    in_lists = lists.count()

    hubs = lists.groupBy("v").agg(F.min(F.struct("unshared", *CLASS)).alias("hub"), F.count("*").alias("members"))
    hubs = store(hubs.filter("members > 1").select("v", F.col("hub.node").alias("hub"), F.col("hub.mark").alias("hub_mark"),
                                                   "members"), "hubs")
    pairs = (meet(lists, hubs, ["v"], "members", in_lists).filter("node <> hub")
             .select(*CLASS, "hub", "hub_mark").distinct())
    # The estimate: of the SKETCH smallest values of the union, those that both retain. It has to be clearly too low.
    a, b = (classes.select(F.col("node").alias(name), F.col("mark").alias(mark), F.col("n").alias(f"n_{name}"),
                           F.col("sketch").alias(f"s_{name}")) for name, mark in (("node", "mark"), ("hub", "hub_mark")))
    union = F.slice(F.array_sort(F.array_union("s_node", "s_hub")), 1, SKETCH)
    both = F.size(F.array_intersect(union, F.array_intersect("s_node", "s_hub")))
    # A sketch of fewer than SKETCH values is a whole set, and the estimate is exact for it.
    enough = both >= F.least(required(F.size(union), threshold), F.size(union))
    close = 100 * F.least("n_node", "n_hub") >= round(100 * threshold) * F.greatest("n_node", "n_hub")
    pairs = store(pairs.join(a, CLASS).join(b, ["hub", "hub_mark"]).filter(close & enough)
                  .select(*CLASS, "hub", "hub_mark"), "pairs")

    ids = pairs.select(*CLASS).unionAll(pairs.select(F.col("hub").alias("node"), F.col("hub_mark").alias("mark")))
    several = hubs.filter("members > 2")
    ids = store(ids.unionAll(meet(lists, several, ["v"], "members", in_lists).select(*CLASS)).distinct(), "candidates")
    sets = store(full_sets(docs, ids, width), "sets")
    whole = (pairs.join(sets, CLASS).withColumnRenamed("shingles", "left")
             .join(sets.select(F.col("node").alias("hub"), F.col("mark").alias("hub_mark"), "shingles"), ["hub", "hub_mark"]))
    links = (whole.filter(_linked(F.size(F.array_intersect("left", "shingles")), F.size("left"), F.size("shingles"), threshold))
             .select(F.col("node").alias("a"), F.col("hub").alias("b")))
    links = store(links.unionAll(_one_id(sketched, classes)), "links")
    found = store(components(links, "hub"), "components")

    # What is left: lists in which, besides the hub, several components meet.
    rest = meet(lists, several, ["v"], "members", in_lists).filter("node <> hub or mark <> hub_mark").select("v", *CLASS)
    rest = store(rest.join(found, "node", "left").withColumn("component", F.coalesce("component", "node")), "open")
    open_lists = rest.groupBy("v").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                       F.count("*").alias("left"))
    rest = meet(rest, open_lists.filter("low <> high").select("v", "left"), ["v"], "left", in_lists).drop("left")
    more = store(_compare(tiles(rest, ["v"], "node", TILE, in_lists).join(sets, CLASS), threshold), "more-links")
    found = store(components(links.unionAll(more), "all"), "components")

    named = (classes.join(found, "node", "left")
             .select(*SIGNATURE, F.coalesce("component", "node").alias("class_component"), "copies", "node")
             .filter("copies > 1 or class_component <> node"))
    whole = sketched.select("doc_id", *SIGNATURE).join(named.select(*SIGNATURE, "class_component"), SIGNATURE, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("class_component", "doc_id"))
    return whole.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
                        F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, width: int = 5, threshold: float = THRESHOLD) -> DataFrame:
    """The documents but for those that have a near duplicate with a smaller doc_id in their group."""
    gone = (near_duplicates(docs, width, threshold).filter("not kept")
            .select(F.col("doc_id").alias("_gone_id")).distinct())
    return docs.join(gone, docs["doc_id"] == gone["_gone_id"], "left_anti")
