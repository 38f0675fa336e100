"""Chat formatting by a prefix tree of conversations.

A turn is written as `<|turn|>` role `<|text|>` text `<|end|>`. Control strings inside roles and texts, those of this
template and of common others (CONTROL), are escaped: each backslash is doubled, and one backslash is put after the
first character of a control string, so that no text can end or begin a turn, and every text comes back unchanged.

Conversations that begin with the same turns share them: sorted by their turns' hashes, those with equal beginnings
are neighbours, and a task that reads them in order writes each turn's tokens once, depth first, as the turns that
the conversation before does not have. This gives blocks of at most about BLOCK tokens or LEAVES conversations, each with

    ids         token ids of its segments (turns) in depth-first order
    positions   place of each token in its conversation, so a branch goes on where its parent ended
    loss        1 for the tokens of an assistant's text, else 0
    segments    parent segment (-1 for a first turn), first and last+1 token, and the intervals of tokens of all
                ancestors: a token attends to these and to the earlier ones of its own segment
    leaves      conversation id and its last segment; run, runs and first are 0, 1 and 0 for a whole conversation

A block that begins within a shared beginning writes it once more, so that blocks stand alone: a beginning that a third
of all conversations share is written once per block, and no task holds more than a block and a conversation.

A conversation of more than RUN characters or TURNS turns is not gathered: its turns are dealt by range in their order
and cut into runs of about RUN characters or TURNS turns, each a block of its own. Its leaf names the run, how many
there are, and `first`, the place of the block's first token in the conversation: the block continues the run before,
and its positions count from there. Blocks are read back one by one; the digests of runs are folded in order by one
task, which holds a batch of runs at a time. Range bounds use the first KEY characters of roles and texts, so turns of
one conversation that are equal up to there are sorted by one task.

Turns are in order of turn, of equal ones in order of role and text; null roles and texts are empty, a null turn comes
first, and rows without conv_id are one conversation. Texts may be of any length, also of white space alone. Repeated rows are repeated turns. An empty table gives no blocks.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import map_arrow, map_batches, store
from kerbside.llm.packing import byte_encoder

# Marks of this template and of widespread ones.
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
CONTROL = re.compile(r"<\|[A-Za-z0-9_]+\|>|</?s>|\[/?INST\]|<</?SYS>>")
ASSISTANT = "assistant"
TOKENIZER = "byte_bpe_50k.json"
BLOCK, LEAVES = 1 << 16, 2048
RUN, TURNS, KEY = 1 << 18, 4096, 128

SEGMENT = pa.struct([("parent", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()),
                     ("attends", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())])))])
LEAF = pa.struct([("conv_id", pa.int64()), ("segment", pa.int32()), ("run", pa.int32()), ("runs", pa.int32()),
                  ("first", pa.int64())])
BLOCKS = pa.schema([("ids", pa.list_(pa.int32())), ("positions", pa.list_(pa.int32())), ("loss", pa.list_(pa.int8())),
                    ("segments", pa.list_(SEGMENT)), ("leaves", pa.list_(LEAF))])
BLOCK_SCHEMA = ("ids array<int>, positions array<int>, loss array<tinyint>, segments array<struct<parent:int, "
                "start:int, stop:int, attends:array<struct<start:int, stop:int>>>>, "
                "leaves array<struct<conv_id:long, segment:int, run:int, runs:int, first:long>>")
DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long")
PARTS = f"{DIGESTS}, run int, runs int, whole binary, learned binary"


def escape(text: str) -> str:
    return CONTROL.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text.replace("\\", "\\\\"))


def unescape(text: str) -> str:
    return re.sub(r"\\(\\?)", r"\1", text)


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    turns = []
    for part in formatted.split(TURN)[1:]:
        role, rest = part.split(TEXT)
        turns.append((unescape(role), unescape(rest[:-len(END)])))
        if not rest.endswith(END) or END in rest[:-len(END)]:
            raise ValueError("not written by this template")
    if formatted and not formatted.startswith(TURN):
        raise ValueError("not written by this template")
    return turns


def conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, path, turns): turns in order, and their hashes, by which equal beginnings become neighbours."""
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (rows.groupBy(F.col("conv_id").cast("long").alias("conv_id"))
            .agg(F.sort_array(F.collect_list(turn)).alias("turns"))
            .select("conv_id", F.transform("turns", lambda t: F.xxhash64(t["role"], t["text"])).alias("path"),
                    F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
                    .alias("turns")))


class _Tree:
    """A block under construction. `open` holds the segments of the conversation read last, by depth."""

    def __init__(self, encode) -> None:
        self.encode = encode
        self.ids, self.positions, self.loss = array("i"), array("i"), array("b")
        self.segments: list[dict] = []
        self.leaves: list[dict] = []
        self.open: list[tuple[tuple[str, str], int]] = []

    def add(self, conv_id: int | None, turns: list[tuple[str, str]]) -> None:
        shared = 0
        while shared < min(len(turns), len(self.open)) and self.open[shared][0] == turns[shared]:
            shared += 1
        del self.open[shared:]
        for role, text in turns[shared:]:
            parent = self.open[-1][1] if self.open else -1
            start = len(self.ids)
            for part, learned in ((TURN + escape(role) + TEXT, 0), (escape(text), int(role == ASSISTANT)), (END, 0)):
                found = self.encode(part)
                self.ids.extend(found)
                self.loss.extend([learned] * len(found))
            above = [] if parent < 0 else [*self.segments[parent]["attends"], {
                "start": self.segments[parent]["start"], "stop": self.segments[parent]["stop"]}]
            if len(above) > 1 and above[-2]["stop"] == above[-1]["start"]:
                above[-2:] = [{"start": above[-2]["start"], "stop": above[-1]["stop"]}]
            first = sum(a["stop"] - a["start"] for a in above)
            self.positions.extend(range(first, first + len(self.ids) - start))
            self.open.append(((role, text), len(self.segments)))
            self.segments.append({"parent": parent, "start": start, "stop": len(self.ids), "attends": above})
        self.leaves.append({"conv_id": conv_id, "segment": self.open[-1][1] if self.open else -1,
                            "run": 0, "runs": 1, "first": 0})

    def full(self) -> bool:
        return len(self.ids) >= BLOCK or len(self.leaves) >= LEAVES

    def batch(self) -> pa.RecordBatch:
        columns = [np.asarray(self.ids), np.asarray(self.positions), np.asarray(self.loss), self.segments, self.leaves]
        return pa.RecordBatch.from_arrays([pa.array([c], field.type) for c, field in zip(columns, BLOCKS)],
                                          schema=BLOCKS)


def long_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id) of conversations that are cut into runs: at most one per RUN characters or TURNS turns of the input."""
    chars = sum(F.coalesce(F.length(c), F.lit(0)).cast("long") for c in ("role", "text"))
    return (rows.groupBy(F.col("conv_id").cast("long").alias("conv_id"))
            .agg(F.count("*").alias("n"), F.sum(chars).alias("chars"))
            .filter((F.col("n") > TURNS) | (F.col("chars") > RUN)).select("conv_id"))


def format_runs(rows: DataFrame) -> DataFrame:
    """Blocks of long conversations, each of one run of turns."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(TOKENIZER).plain_ids
        place = TaskContext.get().partitionId() << 32
        conv_id, turns, chars = None, [], 0

        def block() -> pa.RecordBatch:
            tree = _Tree(encode)
            tree.add(conv_id, turns)
            made = tree.batch()
            return pa.RecordBatch.from_arrays(
                [*made.columns, pa.array([conv_id], pa.int64()), pa.array([place]), pa.array([len(tree.ids)])],
                [*made.schema.names, "conv_id", "place", "n"])

        for batch in batches:
            for following, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if turns and (following != conv_id or chars >= RUN or len(turns) >= TURNS):
                    yield block()
                    turns, chars, place = [], 0, place + 1
                conv_id = following
                turns.append((role, text))
                chars += len(role) + len(text)
        if turns:
            yield block()

    key = ["conv_id", "turn", *(F.substring(c, 1, KEY) for c in ("role", "text"))]
    ordered = (rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn",
                           *(F.coalesce(c, F.lit("")).alias(c) for c in ("role", "text")))
               .repartitionByRange(*key).sortWithinPartitions("conv_id", "turn", "role", "text"))
    runs = store(map_arrow(ordered.select("conv_id", "role", "text"), run,
                           f"{BLOCK_SCHEMA}, conv_id long, place long, n long"), "chat-runs")
    # One short row per run; places follow the order of turns.
    each = Window.partitionBy("conv_id")
    before = each.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.select("place", (F.row_number().over(each.orderBy("place")) - 1).alias("run"),
                         F.count("*").over(each).cast("int").alias("runs"),
                         F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("first"))
    leaf = F.struct("conv_id", F.col("leaves")[0]["segment"].alias("segment"), "run", "runs", "first")
    return runs.join(placed, "place").select("ids", "positions", "loss", "segments", F.array(leaf).alias("leaves"))


def format_conversations(rows: DataFrame) -> DataFrame:
    """Blocks of a table with columns conv_id, turn, role and text."""
    found = store(long_conversations(rows), "chat-long")
    if found.isEmpty():
        return format_whole(rows)
    # One per RUN characters of the input, so their number grows with it: Spark chooses the join by measured size.
    found = found.withColumnRenamed("conv_id", "found")
    is_long = F.col("conv_id").cast("long").eqNullSafe(F.col("found"))
    return format_whole(rows.join(found, is_long, "left_anti")).unionAll(
        format_runs(rows.join(found, is_long, "left_semi")))


def format_whole(rows: DataFrame) -> DataFrame:
    """Blocks of conversations that are gathered whole."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_encoder(TOKENIZER).plain_ids
        tree = _Tree(encode)
        for batch in batches:
            for row in batch.to_pylist() if batch.num_rows < LEAVES else (
                    r for at in range(0, batch.num_rows, LEAVES) for r in batch.slice(at, LEAVES).to_pylist()):
                tree.add(row["conv_id"], [(t["role"], t["text"]) for t in row["turns"]])
                if tree.full():
                    yield tree.batch()
                    tree = _Tree(encode)
        if tree.leaves:
            yield tree.batch()
    ordered = conversations(rows).repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    return map_arrow(ordered.select("conv_id", "turns"), run, BLOCK_SCHEMA)


def read_back(blocks: DataFrame) -> DataFrame:
    """What each conversation of the blocks says, from ids, attention intervals and loss mask alone."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = byte_encoder(TOKENIZER).coder
        out = []
        tokens = [batch.column(c) for c in ("ids", "positions", "loss")]
        trees = zip(batch.column("segments").to_pylist(), batch.column("leaves").to_pylist())
        for k, (segments, leaves) in enumerate(trees):
            ids, positions, loss = (column[k].values.to_numpy() for column in tokens)
            for leaf in leaves:
                last = segments[leaf["segment"]]
                at = np.concatenate([np.arange(a["start"], a["stop"]) for a in [*last["attends"], last]])
                if not np.array_equal(positions[at], np.arange(len(at))):
                    raise ValueError("positions of a conversation do not follow each other")
                formatted = coder.decode(ids[at].tolist())
                turns = parse(formatted)
                learned = unescape(coder.decode(ids[at[loss[at] > 0]].tolist()))
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                raw = [part.encode("utf-8", "surrogatepass") for part in (whole, learned)]
                alone = leaf["runs"] == 1
                hashes = [hashlib.sha256(part).hexdigest() if alone else None for part in raw]
                out.append((leaf["conv_id"], len(turns), hashes[0], len(learned), hashes[1], len(formatted),
                            leaf["run"], leaf["runs"], *([None, None] if alone else raw)))
        return _batch(out, PARTS)
    parts = map_batches(blocks, work, PARTS).repartition("conv_id").sortWithinPartitions("conv_id", "run")
    return map_arrow(parts, _fold, DIGESTS)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation, from rows in order of conversation and run."""
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["runs"] == 1:
                out.append(tuple(row.values())[:6])
                continue
            if row["run"] == 0:
                due, sums, hashes = 0, [0, 0, 0], [hashlib.sha256(), hashlib.sha256()]
            if row["run"] != due:
                raise ValueError("a run of a conversation is missing")
            due += 1
            sums = [a + row[c] for a, c in zip(sums, ("n_turns", "loss_chars", "formatted_chars"))]
            hashes[0].update(row["whole"])
            hashes[1].update(row["learned"])
            if due == row["runs"]:
                out.append((row["conv_id"], sums[0], hashes[0].hexdigest(), sums[1], hashes[1].hexdigest(), sums[2]))
        yield _batch(out, DIGESTS)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(field.split() for field in schema.split(", ")))
    types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    columns = list(zip(*rows)) or [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, types[k]) for c, k in zip(columns, kinds)], names)
