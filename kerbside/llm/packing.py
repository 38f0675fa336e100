"""Packing of documents into sequences of a fixed length, in stored order, by dynamic programming.

The token streams of a task's documents lie end to end. Cuts may fall at document ends (free), at sentence ends
(`SENTENCE_CUT`) and, inside long stretches without either, at any multiple of `HARD_STEP` tokens (`HARD_CUT`). A
sequence is the stretch between two cuts, at most `length` tokens; it costs its padding plus the penalty of its last
cut plus `SEQUENCE`. Padding is `length - n`, or nothing where n is a power of two of at least `LEAST_POWER`, since such
sequences are batched at their own size; the last sequence of a block may be any power of two. (Batches of shorter
sequences cost more than they save, so they are only made of what is left.) The cheapest cuts are found by

    best(j) = penalty(j) + min over i of best(i) + padding(pos(j) - pos(i))

in which the minimum over the window pos(j) - pos(i) <= length is kept in a monotone queue, and powers of two are
looked up by position. The stream is cut into blocks of about `BLOCK` tokens, each solved by itself, so a task
holds one block and one document whatever its input. Nothing is shuffled: a task packs the rows that it scans.

Texts are encoded by a fast encoder, whose pattern fails on runs of white space of more than about a million characters;
texts with one of more than BLANKS are encoded by the tokenizers library, with the same ids.

Null texts are empty; an empty text still has its end token. Rows that repeat a doc_id are packed once each. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from kerbside.llm.common import BATCH_ROWS, map_arrow, texts_of

LENGTH = 2048
BLOCK = 1 << 18
# Penalties in tokens of padding.
SENTENCE_CUT, HARD_CUT, SEQUENCE = 1.0, 24.0, 4.0
# Tokens between two hard cuts.
HARD_STEP = 128
LEAST_POWER = 256
END_ID = 1
# Characters of white space in a row that the fast encoder is trusted with.
BLANKS = 50_000
WHITE_RUN = re.compile(r"\s+")
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_tokens long")


class ByteEncoder:
    """Ids of the byte-level tokenizer in a file, as the tokenizers library gives them.

    Encodes by the same vocabulary as ranks, which is several times as fast; added tokens found in a text count.
    """

    def __init__(self, name: str) -> None:
        with open(public_tokenizers.path(name.replace(".json", ".tiktoken")), "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.library = Tokenizer.from_file(public_tokenizers.path(name))
        self.library.no_truncation()
        self.library.no_padding()
        added = self.library.get_added_tokens_decoder()
        self.coder = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                       special_tokens={token.content: i for i, token in added.items()})
        self.ends_sentence = np.zeros(max(max(ranks.values()), *added) + 1, bool)
        for token, i in ranks.items():
            self.ends_sentence[i] = token.rstrip(b" ")[-1:] in (b".", b"!", b"?", b"\n")

    def ids(self, text: str) -> np.ndarray:
        if long_blanks(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.coder.encode_to_numpy(text, allowed_special="all")

    def plain_ids(self, text: str) -> list[int]:
        """Ids that decode to the text, in which special tokens are ordinary text. Long white space is cut into parts."""
        runs = long_blanks(text)
        if not runs:
            return self.coder.encode_ordinary(text)
        cuts = [0, *(at for low, high in runs for at in range(low + BLANKS, high, BLANKS)), len(text)]
        return [i for low, high in zip(cuts, cuts[1:]) for i in self.coder.encode_ordinary(text[low:high])]


def long_blanks(text: str) -> list[tuple[int, int]]:
    """Where a text has more than BLANKS characters of white space in a row."""
    if len(text) <= BLANKS:
        return []
    return [m.span() for m in WHITE_RUN.finditer(text) if m.end() - m.start() > BLANKS]


@lru_cache(maxsize=2)
def byte_encoder(name: str) -> ByteEncoder:
    return ByteEncoder(name)


def cut_places(ids: np.ndarray, ends_sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places after which a document may be cut, and their penalties; the last one is its end.

    `ids` ends with the end token, which is not parted from what stands before it by a sentence cut.
    """
    n = len(ids)
    ends = np.flatnonzero(ends_sentence[ids[:-2]]) + 1 if n > 2 else np.empty(0, np.int64)
    marks = np.r_[0, ends, n]
    gaps = np.flatnonzero(np.diff(marks) > HARD_STEP)
    hard = [np.arange(marks[g] + HARD_STEP, marks[g + 1], HARD_STEP) for g in gaps]
    places = np.concatenate([marks[1:], *hard])
    penalty = np.concatenate([np.full(len(ends), SENTENCE_CUT), [0.0], np.full(len(places) - len(ends) - 1, HARD_CUT)])
    order = np.argsort(places, kind="stable")
    return places[order], penalty[order]


def best_cuts(places: np.ndarray, penalty: np.ndarray, length: int = LENGTH) -> list[int]:
    """The cheapest choice of cuts, as positions from 0 to the last place. No gap may exceed `length`."""
    spots = [0, *places.tolist()]
    costs = [0.0, *(penalty + (length + SEQUENCE)).tolist()]
    at = dict(zip(spots, range(len(spots)))).get
    powers = [1 << k for k in range(length.bit_length()) if LEAST_POWER <= 1 << k < length]
    best = [0.0]
    came = [0]
    # The window's starts with increasing best + position; `head` is the first one still in reach.
    queue, keys, head = [0], [0.0], 0
    for j in range(1, len(spots)):
        here = spots[j]
        if j == len(spots) - 1:
            powers = [1 << k for k in range(length.bit_length()) if 1 << k < length]
        while here - spots[queue[head]] > length:
            head += 1
        i = queue[head]
        least = keys[head] - here
        for power in powers:
            k = at(here - power)
            if k is not None and best[k] - length < least:
                least, i = best[k] - length, k
        value = least + costs[j]
        best.append(value)
        came.append(i)
        value += here
        while len(keys) > head and keys[-1] >= value:
            keys.pop()
            queue.pop()
        keys.append(value)
        queue.append(j)
    cuts, j = [], len(spots) - 1
    while j:
        cuts.append(spots[j])
        j = came[j]
    return [0, *reversed(cuts)]


class _Block:
    """Documents that are cut together."""

    def __init__(self, first_sequence: int) -> None:
        self.docs: list[tuple[int | None, np.ndarray, int, int]] = []
        self.places: list[np.ndarray] = []
        self.penalty: list[np.ndarray] = []
        self.size, self.sequence = 0, first_sequence

    def add(self, doc_id: int | None, ids: np.ndarray, start: int, total: int, ends: np.ndarray) -> None:
        places, penalty = cut_places(ids, ends)
        self.docs.append((doc_id, ids, start, total))
        self.places.append(places + self.size)
        self.penalty.append(penalty)
        self.size += len(ids)

    def pieces(self, length: int) -> Iterator[tuple]:
        """One row per piece of a document; counts `sequence` on."""
        cuts = best_cuts(np.concatenate(self.places), np.concatenate(self.penalty), length)
        low, k = 0, 1
        for doc_id, ids, start, total in self.docs:
            done = 0
            while done < len(ids):
                while cuts[k] <= low + done:
                    k += 1
                n = min(len(ids), cuts[k] - low) - done
                part = ids[done:done + n]
                yield (doc_id, start + done, n, zlib.crc32(part.tobytes()), total, self.sequence + k - 1,
                       low + done - cuts[k - 1], cuts[k] - cuts[k - 1])
                done += n
            low += len(ids)
        self.sequence += len(cuts) - 1


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", length: int = LENGTH) -> DataFrame:
    """Pieces of all documents with the sequence and offset where they lie. Sequence ids are unique, not dense."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(tokenizer)
        block = _Block(TaskContext.get().partitionId() << 40)
        names = [field.split()[0] for field in SCHEMA.split(", ")]

        def flush(done: _Block) -> Iterator[pa.RecordBatch]:
            if done.size:
                columns = zip(*done.pieces(length))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                rows = batch.slice(at, BATCH_ROWS)
                for doc_id, text in zip(rows.column("doc_id").to_pylist(), texts_of(rows)):
                    ids = np.append(encoder.ids(text), np.uint32(END_ID)).astype("<u4")
                    for start in range(0, len(ids), BLOCK):  # a document may span blocks
                        block.add(doc_id, ids[start:start + BLOCK], start, len(ids), encoder.ends_sentence)
                        if block.size >= BLOCK:
                            yield from flush(block)
                            block = _Block(block.sequence)
        yield from flush(block)
    return map_arrow(docs.select("doc_id", "text"), run, SCHEMA)
