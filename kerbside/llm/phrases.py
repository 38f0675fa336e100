"""Document fingerprints by locally consistent parsing.

A text is cut into phrases by what stands near each place only, so equal stretches of two texts are cut alike inside,
wherever they begin. One level works so: runs of one symbol become one symbol; deterministic coin tossing gives each
symbol a small label out of it and the one before (twice the place of the lowest bit where the two differ, plus
that bit), again and again until labels are below 6; neighbours always differ, and a phrase begins at each local
maximum. A phrase is named by a hash of its symbols, and the names are the symbols of the next level.

A fingerprint holds, for each of the LEVELS, the NAMES smallest distinct phrase names, cut to 32 bits. Likeness is the
Dice share that two fingerprints have in common, estimated from the smallest names of both, on the highest level on
which both have at least ENOUGH names, or the first one. Two empty texts are alike, an empty text and another are not.

Null texts are empty. `fingerprints_with_next` pairs each document with the next one in descending order of doc_id
(equal ids in descending order of text, rows without id last) and the last with the first, as one of a table's only
row with itself. Documents are dealt by ranges of doc_id; of each range only the first document is sent on to the
range before, so no order over all texts is built in one task. An empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import map_arrow

LEVELS = (1, 2, 3)
NAMES = 40
ENOUGH = 12
# Characters that are parsed together, and documents.
CHARS, DOCS = 1 << 19, 200
RANGES_PER_PARTITION = 8
LOWEST = -(1 << 63)
SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")

_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD[0]
    x = (x ^ (x >> np.uint64(29))) * _ODD[1]
    return x ^ (x >> np.uint64(32))


@lru_cache(maxsize=4)
def _tosses(size: int) -> np.ndarray:
    """Labels of all pairs (symbol before, symbol) of labels below `size`."""
    before, here = np.meshgrid(np.arange(size), np.arange(size), indexing="ij")
    apart = before ^ here
    place = np.where(apart, np.bitwise_count((apart & -apart) - 1), 0).astype(np.int64)
    return (2 * place + (here >> place & 1)).astype(np.uint8).ravel()


@lru_cache(maxsize=1)
def _powers() -> np.ndarray:
    """Powers of an odd number, for more symbols than a phrase can have."""
    return np.cumprod(np.full(64, _ODD[2]))


def next_level(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrase names of several sequences that lie end to end; `first` marks where each one begins."""
    change = np.empty(len(symbols), bool)
    change[0] = True
    np.not_equal(symbols[1:], symbols[:-1], out=change[1:])
    change |= first
    starts = np.flatnonzero(change)
    length = np.diff(starts, append=len(symbols))
    symbols, first = symbols[starts].astype(np.uint64), first[starts]
    runs = np.flatnonzero(length > 1)
    symbols[runs] = _mix(symbols[runs] + length[runs].astype(np.uint64) * _ODD[2])

    before = np.empty_like(symbols)
    before[0] = 0
    before[1:] = symbols[:-1]
    apart = symbols ^ before
    heads = np.flatnonzero(first)
    apart[heads] = 1  # as if one came before it that differs in the lowest bit
    place = np.minimum(np.bitwise_count((apart & (~apart + np.uint64(1))) - np.uint64(1)), 63).astype(np.uint64)
    label = (place * np.uint64(2) + ((symbols >> place) & np.uint64(1))).astype(np.uint8)
    for size in (128, 14, 8, 6):
        table = _tosses(size)
        pair = label.astype(np.uint16)
        pair[1:] += label[:-1].astype(np.uint16) * np.uint16(size)
        pair[heads] = (label[heads] ^ 1).astype(np.uint16) * np.uint16(size) + label[heads]
        label = table[pair]
    rises = np.empty(len(label), bool)
    np.greater(label[1:], label[:-1], out=rises[1:])
    top = first.copy()
    top[1:-1] |= rises[1:-1] & (~rises[2:] | first[2:])  # neighbours differ: what does not rise falls
    top[-1] |= rises[-1]
    begin = np.flatnonzero(top)
    of = np.cumsum(top) - 1
    inside = np.arange(len(symbols)) - begin[of]
    powers = _powers()
    if inside.max() >= len(powers):  # only where a sequence begins or hashes collide
        inside = np.minimum(inside, len(powers) - 1)
    names = _mix(np.add.reduceat(_mix(symbols) * powers[inside], begin))
    return names, first[begin]


def fingerprints(texts: list[str]) -> list[str]:
    """Fingerprints of several texts."""
    found = [[] for _ in texts]
    filled = [i for i, text in enumerate(texts) if text]
    if filled:
        symbols = np.frombuffer("".join([texts[i] for i in filled]).encode("utf-32-le", "surrogatepass"), "<u4")
        first = np.zeros(len(symbols), bool)
        first[np.cumsum([0, *[len(texts[i]) for i in filled]])[:-1]] = True
        for level in range(1, LEVELS[-1] + 1):
            symbols, first = next_level(symbols, first)
            if level in LEVELS:
                short = (symbols & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                bounds = [*np.flatnonzero(first).tolist(), len(short)]
                for k, i in enumerate(filled):
                    part = short[bounds[k]:bounds[k + 1]]
                    if len(part) > 4 * NAMES:  # a few more than needed, as there may be equal ones
                        low = np.unique(np.partition(part, 2 * NAMES)[:2 * NAMES])
                        part = low if len(low) >= NAMES else part
                    found[i].append(np.unique(part)[:NAMES].astype(">u4").tobytes().hex())
    return [".".join(levels) for levels in found]


def _names(level: str) -> list[str]:
    return [level[k:k + 8] for k in range(0, len(level), 8)]


def likeness(a: str, b: str) -> float:
    """The share, from 0 to 1, that two fingerprints have in common."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    for x, y in list(zip(a.split("."), b.split(".")))[::-1]:
        if min(len(x), len(y)) >= 8 * ENOUGH:
            break
    x, y = set(_names(x)), set(_names(y))
    # Names beyond the smallest of a full list may be missing from it.
    limits = [max(names) for names in (x, y) if len(names) == NAMES]
    union = sorted(name for name in x | y if not limits or name <= min(limits))
    common = sum(name in x and name in y for name in union)
    return 2 * common / (len(union) + common)


def edit(text: str, following: str) -> str:
    """A text whose last half is replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ranges, each in order and closed by the first row of the next range."""
    held: list[tuple] = []  # (range, doc_id, text), the last one waiting for its next
    names = [field.split()[0] for field in SCHEMA.split(", ")]

    def flush() -> pa.RecordBatch | None:
        pairs = [k for k in range(len(held) - 1) if held[k][0] == held[k + 1][0]]
        edited = [edit(held[k][2], held[k + 1][2]) for k in pairs]
        own = fingerprints([text for _, _, text in held])
        other = fingerprints(edited)
        rows = [(held[k][1], len(held[k][2]), hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
                 own[k], changed, likeness(own[k], changed), likeness(own[k], own[k + 1]))
                for k, text, changed in zip(pairs, edited, other)]
        del held[:-1]
        if rows:
            types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, DOCS):
            part = batch.slice(at, DOCS)
            for row in zip(*(part.column(c).to_pylist() for c in ("range", "doc_id", "text"))):
                held.append((row[0], row[1], row[2] or ""))
                size += len(held[-1][2])
                if size >= CHARS or len(held) >= DOCS:
                    if out := flush():
                        yield out
                    size = len(held[-1][2])
    if held and (out := flush()):
        yield out


def fingerprints_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likeness."""
    # A null id comes after all others.
    ordered = docs.select("doc_id", F.coalesce("doc_id", F.lit(LOWEST)).alias("place"),
                          F.coalesce("text", F.lit("")).alias("text"))
    # As many ranges as keep a task's share small, whatever the number of its partitions is set to for an input.
    n = RANGES_PER_PARTITION * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds = ordered.approxQuantile("place", [k / n for k in range(1, n)], 0.25 / n)
    splits = [-float("inf"), *(sorted(set(bounds)) or [0.0]), float("inf")]
    cut = Bucketizer(splits=splits, inputCol="place", outputCol="bucket").transform(ordered)
    dealt = cut.select((F.lit(len(splits)) - F.col("bucket")).cast("int").alias("range"), "doc_id", "place", "text")
    # The first row of each range, one row per range, closes the range before it, the very first one the last.
    highest = dealt.groupBy("range").agg(F.max("place").alias("place"))
    firsts = (dealt.join(F.broadcast(highest), ["range", "place"]).groupBy("range")
              .agg(F.max(F.struct("place", "text", "doc_id")).alias("row")))
    order = Window.partitionBy(F.lit(0)).orderBy("range")
    before = F.coalesce(F.lag("range").over(order), F.max("range").over(Window.partitionBy(F.lit(0))))
    closing = firsts.select(before.alias("range"), "row.doc_id", "row.place", "row.text", F.lit(1).alias("closes"))
    rows = dealt.withColumn("closes", F.lit(0)).unionByName(closing)
    ordered = rows.repartition("range").sortWithinPartitions("range", "closes", F.desc("place"), F.desc("text"))
    return map_arrow(ordered.select("range", "doc_id", "text"), _with_next, SCHEMA)
