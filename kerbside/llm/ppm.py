"""Scores of whole texts by prediction by partial matching over their bytes.

A text is its words (A-Z in lower case) with one blank between them and an end behind them, as symbols: bytes, and the end.
Each symbol is predicted from the ORDER symbols before it, across word borders; before a text's first symbol stand ORDER
starts. The trie of byte contexts holds every context of the training texts, of every length down to none:

- a context in which n symbols were counted, q of them different, predicts a symbol counted c times with
  (2 c - 1) / (2 n) and escapes to the context without its first symbol with q / (2 n);
- symbols that a longer context has seen are excluded from shorter ones: n and q are those of the symbols left there;
- a context that was not seen is passed by, and where no context has seen a symbol, those left of all 257 are alike.

The longest contexts count every place in the training texts. By update exclusion a shorter context counts a symbol only
where the longer one had not seen it, that is once for each different longer context. The score is the log10 probability
of all symbols of a text: the sum over its places, each decided by the window of its symbol and the ORDER before it.

Nothing that grows with the corpus is collected or broadcast by this module. Tasks write texts (compressed) in blocks of about
BLOCK bytes with the sorted distinct keys of each block, its windows and tokens, and their training counts. A shuffle adds
these up; each shorter level of the trie is an aggregate of the one above. The distinct windows of all texts take a join with
the nodes and one with the contexts of each level, longest first; those that were seen there are done, and few go on. Values
go back to the blocks that asked for them, in single precision, and each text adds up its own: a
bounded group, whose size does not follow the corpus. A window's key is its code; a token's is a 63-bit hash, less than 0, so
among ten billion different tokens a few may be counted together.

The base score adds one to each token's count, as log10((c + 1) / (N + V + 1)); tokens are words and one end. Null texts
are empty: their only token and symbol is the end. Repeated rows are learned and scored once each, rows without doc_id as
those of an unknown fold that is not held out. With no training text all symbols are alike. An empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import BATCH_ROWS, checksum, id_checksum, map_arrow, store, texts_of, words_of
from kerbside.llm.minhash import WORD_HASHES

FOLD, FOLDS = 2, 7
ORDER = 5
BITS = 9
START = 257  # before a text, and its end; a byte b is symbol b + 1
SYMBOLS = 257
BLOCK = 1 << 25
# Places of a long text that are looked at together, keys that are held before they are counted, and list sizes.
STEP, HELD, CHUNK = 1 << 20, 1 << 22, 50_000
# Bytes of texts that are compressed together.
PACK = 1 << 20
# Tables that are tried for a key before the sorted ones, their least slots for each key, and keys looked up together.
TABLES, SPARE, TOGETHER = 8, 4, 1 << 16
PREPARED = "block long, doc_ids array<long>, texts binary, keys array<long>, counts array<int>"


def held_out() -> Column:
    return F.coalesce(id_checksum() % FOLDS == FOLD, F.lit(False))


# -- texts as windows --------------------------------------------------------------------------------

def windows(words: list[bytes]) -> Iterator[np.ndarray]:
    """Codes of each place's window, a symbol and the ORDER before it, BITS for each; at most STEP together."""
    line = np.frombuffer(b" ".join(words), np.uint8)
    symbols = np.full(len(line) + ORDER + 1, START, np.int16)
    symbols[ORDER:-1] = line
    symbols[ORDER:-1] += 1
    for at in range(0, len(line) + 1, STEP):
        part = symbols[at:at + STEP + ORDER].astype(np.int64)
        codes = part[:len(part) - ORDER].copy()
        for k in range(1, ORDER + 1):
            codes <<= BITS
            codes |= part[k:len(part) - ORDER + k]
        yield codes


def token_keys(words: list[bytes]) -> np.ndarray:
    """A key below 0 for each token."""
    hashes = np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))
    return ~(hashes >> np.uint64(1)).astype(np.int64)


class _Counted:
    """Sorted distinct keys and how often training texts have them, 0 for those of other texts alone."""

    def __init__(self) -> None:
        self.keys, self.n = np.empty(0, np.int64), np.empty(0, np.int64)
        self.waiting: list[tuple[np.ndarray, bool]] = []
        self.size = 0

    def add(self, keys: np.ndarray, train: bool) -> None:
        self.waiting.append((keys, train))
        self.size += len(keys)
        if self.size >= HELD:
            self.fold()

    def fold(self) -> None:
        for train in (True, False):
            parts = [keys for keys, kind in self.waiting if kind is train]
            if parts:
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                n = n * train
                # Both lists are sorted, and most keys are there after the first rounds: only new ones move others.
                place = np.searchsorted(self.keys, keys)
                new = np.ones(len(keys), bool)
                within = place < len(self.keys)
                new[within] = self.keys[place[within]] != keys[within]
                self.n[place[~new]] += n[~new]
                self.keys, self.n = (np.insert(a, place[new], b[new]) for a, b in ((self.keys, keys), (self.n, n)))
        self.waiting, self.size = [], 0


# Odd factors, one for each table.
_FACTORS = np.random.default_rng(6).integers(1 << 62, 1 << 63, TABLES, np.uint64) * np.uint64(2) + np.uint64(1)


def _slots(keys: np.ndarray, factor: np.uint64, shift: np.uint64) -> np.ndarray:
    """The slot of each key: the highest bits of a product, after the higher half was folded into the lower one."""
    bits = keys.view(np.uint64)
    return (((bits ^ (bits >> np.uint64(32))) * factor) >> shift).view(np.int64)


class Lookup:
    """Values of keys, each of which is known to be there.

    A key that is alone in its slot of a table has its value there, so it is found without a look at any key; those that
    share a slot go on to a smaller table with other slots, and what is left after TABLES of them is searched for.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.tables: list[tuple[np.uint64, np.uint64, np.ndarray]] = []
        while len(keys) and len(self.tables) < TABLES:
            bits = (SPARE * len(keys)).bit_length()
            factor = _FACTORS[len(self.tables)]
            slots = _slots(keys, factor, np.uint64(64 - bits))
            table, last = np.full(1 << bits, np.nan, np.float32), np.zeros(1 << bits, np.int32)
            rows = np.arange(len(keys), dtype=np.int32)
            table[slots], last[slots] = values, rows
            table[slots[last[slots] != rows]] = np.nan
            self.tables.append((factor, np.uint64(64 - bits), table))
            shared = np.isnan(table[slots])
            keys, values = keys[shared], values[shared]
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order], values[order]

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        found, missing = np.empty(len(keys), np.float32), np.arange(len(keys))
        for factor, shift, table in self.tables:
            here = table[_slots(keys, factor, shift)]
            found[missing] = here
            shared = np.flatnonzero(np.isnan(here))
            missing, keys = missing[shared], keys[shared]
            if not len(keys):
                break
        if len(keys):
            found[missing] = self.values[np.searchsorted(self.keys, keys)]
        return found.astype(np.float64)


class _Block:
    """Texts whose distinct windows and tokens are asked for together."""

    def __init__(self, number: int) -> None:
        self.number, self.size = number, 0
        self.ids: list[int | None] = []
        self.texts: list[str] = []
        self.held = 0
        self.counted = _Counted()

    def add(self, doc_id: int | None, text: str, train: bool) -> Iterator[pa.RecordBatch]:
        words = words_of(text)
        for codes in windows(words):
            self.counted.add(codes, train)
        self.counted.add(token_keys([*words, b""]), train)
        self.ids.append(doc_id)
        self.texts.append(text)
        self.held += len(text) + 64
        self.size += len(text) + 64
        if self.held >= PACK:
            yield self.packed()

    def packed(self) -> pa.RecordBatch:
        raw = pa.array(self.texts, pa.large_string())
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, pa.schema([("text", pa.large_string())]),
                               options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(pa.record_batch([raw], ["text"]))
        row = _prepared(self.number, self.ids, sink.getvalue().to_pybytes(), None, None)
        self.ids, self.texts, self.held = [], [], 0
        return row

    def batches(self) -> Iterator[pa.RecordBatch]:
        if self.ids:
            yield self.packed()
        self.counted.fold()
        for low in range(0, len(self.counted.keys), CHUNK):
            part = slice(low, low + CHUNK)
            yield _prepared(self.number, None, None, self.counted.keys[part], self.counted.n[part].astype(np.int32))


def _prepared(*row) -> pa.RecordBatch:
    types = [pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = [field.split()[0] for field in PREPARED.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([value], kind) for value, kind in zip(row, types)], names)


def unpacked(texts: bytes) -> list[str]:
    with pa.ipc.open_stream(texts) as rows:
        return rows.read_all().column("text").to_pylist()


def prepare_texts(docs: DataFrame) -> DataFrame:
    """Packs of texts by block, and the distinct keys of each block with their training counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block(TaskContext.get().partitionId() << 32)
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                for doc_id, text in zip(part.column("doc_id").to_pylist(), texts_of(part)):
                    yield from block.add(doc_id, text, doc_id is None or checksum(doc_id) % FOLDS != FOLD)
                    if block.size >= BLOCK:
                        yield from block.batches()
                        block = _Block(block.number + 1)
        if block.size:
            yield from block.batches()
    return map_arrow(docs.select("doc_id", "text"), run, PREPARED)


# -- the trie ----------------------------------------------------------------------------------------

def _last(symbols: int) -> Column:
    """The last symbols of a code."""
    return F.col("code").bitwiseAND(F.lit((1 << (BITS * symbols)) - 1))


def count_nodes(counted: DataFrame) -> list[DataFrame]:
    """(code, n) of the nodes of each level, from no context up to ORDER symbols, from counted windows."""
    levels = [store(counted.filter("n > 0"), f"ppm-nodes-{ORDER}")]
    for order in range(ORDER - 1, -1, -1):
        shorter = levels[0].groupBy(_last(order + 1).alias("code")).agg(F.count("*").alias("n"))
        levels.insert(0, store(shorter, f"ppm-nodes-{order}"))
    return levels


def contexts(levels: list[DataFrame], order: int) -> DataFrame:
    """(context, n, q, excluded): the symbols counted in each context, how many different ones, and what these
    have in the next shorter context, from which they are excluded."""
    nodes = levels[order].withColumn("context", F.shiftright("code", BITS))
    if not order:
        return nodes.groupBy("context").agg(F.sum("n").alias("n"), F.count("*").alias("q"),
                                            F.lit(0).cast("long").alias("excluded"))
    shorter = levels[order - 1].select(F.col("code").alias("shorter"), F.col("n").alias("n_shorter"))
    return (nodes.withColumn("shorter", _last(order)).join(shorter, "shorter").groupBy("context")
            .agg(F.sum("n").alias("n"), F.count("*").alias("q"), F.sum("n_shorter").alias("excluded")))


def spell(codes: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(code, value): the log10 probability of each window's last symbol after the others."""
    zero = F.lit(0).cast("long")
    rest = codes.select(F.col("code").alias("window"), F.lit(0.0).alias("value"), zero.alias("ex_n"), zero.alias("ex_q"))
    done = []
    for order in range(ORDER, -1, -1):
        rest = rest.withColumn("code", F.col("window").bitwiseAND(F.lit((1 << (BITS * (order + 1))) - 1)))
        rest = rest.withColumn("context", F.shiftright("code", BITS))
        seen = levels[order].withColumnRenamed("n", "c")
        found = rest.join(seen, "code", "left").join(contexts(levels, order), "context", "left")
        n, q = F.col("n") - F.col("ex_n"), F.col("q") - F.col("ex_q")
        part = F.when(F.col("c").isNotNull(), (2 * F.col("c") - 1) / (2 * n)).when(n > 0, q / (2 * n))
        found = store(found.select(
            "window", (F.col("value") + F.coalesce(F.log10(part), F.lit(0.0))).alias("value"),
            F.coalesce("excluded", "ex_n").alias("ex_n"), F.coalesce("q", "ex_q").alias("ex_q"),
            F.col("c").isNotNull().alias("seen")), f"ppm-order-{order}")
        done.append(found.filter("seen").select(F.col("window").alias("code"), "value"))
        rest = found.filter("not seen").drop("seen")
    left = F.greatest(F.lit(SYMBOLS) - F.col("ex_q"), F.lit(1))
    result = rest.select(F.col("window").alias("code"), (F.col("value") - F.log10(left)).alias("value"))
    for each in done:
        result = result.unionAll(each)
    return result


# -- scores ------------------------------------------------------------------------------------------

def by_block(answers: DataFrame) -> DataFrame:
    """(asked_in, keys, values): a task's answers, lists for each block, out of (asked_in, code, value)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def lists(rows: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block, key, value = (np.concatenate([r.column(c).to_numpy() for r in rows]) for c in ("asked_in", "code", "value"))
            order = np.lexsort((key, block))
            block, key, value = block[order], key[order].astype("<i8"), value[order].astype("<f4")
            bounds = np.flatnonzero(np.r_[True, block[1:] != block[:-1], True])
            for low, high in zip(bounds, bounds[1:]):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block[low]]), pa.array([key[low:high].tobytes()], pa.binary()),
                     pa.array([value[low:high].tobytes()], pa.binary())], ["asked_in", "keys", "values"])
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= HELD:
                yield from lists(held)
                held, size = [], 0
        if size:
            yield from lists(held)
    return map_arrow(answers, run, "asked_in long, keys binary, values binary")


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document."""
    prepared = store(prepare_texts(docs), "ppm-texts")
    lists = prepared.filter("keys is not null")
    counted = (lists.select(F.explode(F.arrays_zip("keys", "counts")).alias("each"))
               .groupBy(F.col("each.keys").alias("code")).agg(F.sum(F.col("each.counts").cast("long")).alias("n")))
    counted = store(counted, "ppm-counts")
    windows_counted, tokens = counted.filter("code >= 0"), counted.filter("code < 0")
    stats = tokens.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0)).first()
    total, distinct = int(stats[0]), int(stats[1])
    values = spell(windows_counted, count_nodes(windows_counted)).unionAll(
        tokens.select("code", F.log10(F.col("n") + 1).alias("value")))
    values = store(values, "ppm-values")

    def score(texts: pa.Table, value_of: Lookup) -> list[list]:
        rows, waiting, size = [], [], 0

        def add_waiting() -> None:
            lists = [keys for _, keys in waiting]
            values = value_of(np.concatenate(lists))
            ends = np.cumsum([len(keys) for keys in lists])
            for (row, keys), high in zip(waiting, ends):
                own = values[high - len(keys):high]
                if keys[0] < 0:
                    base = float(own.sum()) - len(own) * math.log10(total + distinct + 1)
                    row[1:4] = len(own), int(np.count_nonzero(own)), base
                else:
                    row[4] += float(own.sum())
            waiting.clear()

        for packed in texts.to_pylist():
            for doc_id, text in zip(packed["doc_ids"], unpacked(packed["texts"])):
                words = words_of(text)
                rows.append([doc_id, 0, 0, 0.0, 0.0])
                for keys in chain([token_keys([*words, b""])], windows(words)):
                    waiting.append((rows[-1], keys))
                    size += len(keys)
                    if size >= TOGETHER:
                        add_waiting()
                        size = 0
        if waiting:
            add_waiting()
        return rows

    def run(texts: pa.Table, answers: pa.Table) -> pa.Table:
        keys, found = (np.concatenate([np.frombuffer(part, kind) for part in answers.column(c).to_pylist()])
                       for c, kind in (("keys", "<i8"), ("values", "<f4")))
        out = score(texts, Lookup(keys, found))
        names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    asked = lists.select(F.col("block").alias("asked_in"), F.explode("keys").alias("code"))
    answers = by_block(asked.join(values, "code").select("asked_in", "code", "value"))
    texts = prepared.filter("texts is not null").select("block", "doc_ids", "texts")
    found = texts.groupBy("block").cogroup(answers.groupBy("asked_in")).applyInArrow(
        run, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return found.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known",
                        F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")
