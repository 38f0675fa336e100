"""Repair of conversations by the cheapest edits, with Four-Russians block tables.

A conversation should read, by the first letters of its roles, `(s?(ua)+)?`: nothing, or turns of user and assistant that
take turns, perhaps after one of the system. Its rows may be kept at no cost, get another role (user or assistant, 3), be
deleted (4), or have an empty turn put in anywhere (3). A row's first fault counts: a blank text, or a role and text seen
earlier in the conversation, force its deletion; a text that does not end in `.`, `!` or `?` costs 3 if it stays.

What an edit leads to depends on one of four states: nothing yet, a user is due after the system, an assistant is due, a
user is due. The costs to go of the four differ by little, so that there are few vectors of them once the least is taken
away (all are worked out from the last one). A row is one of CLASSES symbols; for every vector behind every block of BLOCK
symbols, a table says which vector stands before it and how much it costs. A conversation is swept from its end to its
beginning, a lookup for each block. Then its blocks are expanded in the other direction, from the first one: vectors within
a block are worked out from the one behind it, and of the edits that keep to the least cost, the one of the first letter
in ASCII is taken (Delete, Insert, Keep, Rerole), so that ties come out as the least string of letters.

Rows go in order of turn (null first), of equal ones by the first KEY characters of role and text, then by a digest of
both. They are dealt by ranges of that order and cut into runs of at most RUN rows or about CHARS characters. A task
holds the texts of a run. Of a whole conversation it holds one letter for each row, as its result does. Only the SHA-256
of a conversation of several runs is folded in order by one task, a run at a time. Earlier rows of the same role and text
are found by an aggregate of places, so one text a third of all rows share is no burden.

Null roles and texts are one space, as are a null conv_id and turn in a checksum; rows without conv_id are one
conversation. Repeated rows are duplicates. Roles are told apart by their first character only; any but s, u and a has
to be changed or deleted. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import in_order, key_of, map_arrow, store

# Costs, and the state after a kept or put-in turn. States: 0 nothing yet, 1 a user is due after the system,
# 2 an assistant is due, 3 a user is due.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "o": {}}
DUE = (2, 2, 3, 2)
ROLES = ("user", "user", "assistant", "user")
AT_END = (0, 6, 3, 0)
WHITE = " \t\n\x0b\x0c\r"
# A row's letter: first letter of its role (s, u, a, other), then its fault (none, truncated, blank, duplicate).
INITIALS, FAULTS = "suao", "-tbd"
LETTERS = "ABCDEFGHIJKLMNOP"
CLASSES, BLOCK = 9, 4
RUN, CHARS, KEY = 4096, 1 << 22, 128
SOUND = {"su", "ua", "au"}


# -- block tables ------------------------------------------------------------------------------------

def classes_of(word: str) -> np.ndarray:
    """Symbols of a row's letters: 0 for a row that has to go, else 1 to 4 by role, and 5 to 8 if truncated."""
    letters = np.frombuffer(word.encode("ascii"), np.uint8) - ord("A")
    initial, fault = letters // 4, letters % 4
    return np.where(fault > 1, 0, 1 + initial + 4 * (fault == 1)).astype(np.int64)


def edits(symbol: int, state: int) -> Iterator[tuple[str, int, int]]:
    """The edits of a row in a state: letter, cost, state after it."""
    yield "D", DELETE, state
    if symbol:
        cost = TRUNCATED if symbol > 4 else 0
        after = AFTER[INITIALS[(symbol - 1) % 4]]
        if state in after:
            yield "K", cost, after[state]
        yield "R", REROLE + cost, DUE[state]


def before_row(symbol: int, behind: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to go before a row, by state, from those behind it; turns may be put in before the row."""
    own = [min(cost + behind[after] for _, cost, after in edits(symbol, state)) for state in range(4)]
    due = [min(own[2], INSERT + own[3]), min(own[3], INSERT + own[2])]
    return (min(own[0], INSERT + due[0]), min(own[1], INSERT + due[0]), *due)


class Tables:
    """Normalised vectors, and what stands before each block: `vector[block, behind]` and `cost[block, behind]`."""

    def __init__(self) -> None:
        ids = {AT_END: 0}
        self.vectors, rows = [AT_END], []
        for vector in self.vectors:  # grows while it is read
            row = []
            for symbol in range(CLASSES):
                found = before_row(symbol, vector)
                least = min(found)
                plain = tuple(c - least for c in found)
                if plain not in ids:
                    ids[plain] = len(ids)
                    self.vectors.append(plain)
                row.append((ids[plain], least))
            rows.append(row)
        single = np.array(rows).transpose(1, 0, 2)
        self.one = single[..., 0], single[..., 1]
        self.vector, self.cost = self.one
        for _ in range(BLOCK - 1):
            # The block's last symbol comes first: its result is what stands behind the others.
            last = self.one[0]
            self.vector, self.cost = (
                np.stack([self.vector[:, last[s]] for s in range(CLASSES)], 1).reshape(-1, len(ids)),
                np.stack([self.cost[:, last[s]] + self.one[1][s] for s in range(CLASSES)], 1).reshape(-1, len(ids)))
        self.traced: dict[tuple[bytes, int, int], tuple[str, int]] = {}

    def blocks(self, symbols: np.ndarray) -> tuple[list[int], list[int]]:
        """Codes of the whole blocks from the first on, and the symbols left over at the end."""
        whole = len(symbols) // BLOCK * BLOCK
        powers = CLASSES ** np.arange(BLOCK - 1, -1, -1)
        return (symbols[:whole].reshape(-1, BLOCK) @ powers).tolist(), symbols[whole:].tolist()

    def sweep(self, symbols: np.ndarray, behind: int) -> tuple[int, int, list[int]]:
        """The vector before the rows, its cost, and the vectors behind the rows left over and behind each block, last first."""
        codes, rest = self.blocks(symbols)
        seen, cost = [behind], 0
        for symbol in reversed(rest):
            cost += int(self.one[1][symbol, behind])
            behind = int(self.one[0][symbol, behind])
        for code in reversed(codes):
            seen.append(behind)
            cost += int(self.cost[code, behind])
            behind = int(self.vector[code, behind])
        return behind, cost, seen

    def trace(self, symbols: np.ndarray, seen: list[int], state: int) -> tuple[str, int]:
        """Letters of the cheapest edits of the rows, the least in ASCII, and the state behind them."""
        found = []
        ends = [*range(BLOCK, len(symbols) + 1, BLOCK)]
        parts = [(end - BLOCK, end) for end in ends] + [(len(symbols) // BLOCK * BLOCK, len(symbols))]
        for (start, end), behind in zip(parts, reversed(seen)):
            key = (symbols[start:end].astype(np.uint8).tobytes(), behind, state)
            if key not in self.traced:
                self.traced[key] = self.expand(*key)
            letters, state = self.traced[key]
            found.append(letters)
        return "".join(found), state

    def expand(self, symbols: bytes, behind: int, state: int) -> tuple[str, int]:
        vectors = [self.vectors[behind]]
        for symbol in reversed(symbols):
            vectors.append(before_row(symbol, vectors[-1]))
        vectors.reverse()
        letters = []
        for symbol, here, after in zip(symbols, vectors, vectors[1:]):
            while True:
                options = [(letter, to) for letter, cost, to in edits(symbol, state) if cost + after[to] == here[state]]
                if INSERT + here[DUE[state]] == here[state]:
                    options.append(("I", DUE[state]))
                letter, state = min(options)
                letters.append(letter)
                if letter != "I":
                    break
        return "".join(letters), state


@cache
def tables() -> Tables:
    return Tables()


def cheapest(words: list[str]) -> tuple[int, list[tuple[int, str]]]:
    """The least cost of repairing a conversation whose rows' letters come in runs, and for each run the state before it
    and its edits; turns put in at the end belong to the last one."""
    table = tables()
    runs, behind, cost = [classes_of(word) for word in words], 0, 0
    seen: list[list[int]] = []
    for symbols in reversed(runs):
        behind, least, places = table.sweep(symbols, behind)
        cost += least
        seen.append(places)
    cost += table.vectors[behind][0]
    state, found = 0, []
    for symbols, places in zip(runs, reversed(seen)):
        letters, after = table.trace(symbols, places, state)
        found.append((state, letters))
        state = after
    while AT_END[state]:
        found[-1] = (found[-1][0], found[-1][1] + "I")
        state = DUE[state]
    return cost, found


def repaired(state: int, letters: str, turns: list[tuple[str, str]]) -> list[str]:
    """Lines `role:text` of a run after its edits."""
    rows, lines = iter(turns), []
    for letter in letters:
        role, text = (None, "") if letter == "I" else next(rows)
        if letter == "D":
            continue
        lines.append(f"{role if letter == 'K' else ROLES[state]}:{text}")
        state = AFTER[role[0]][state] if letter == "K" else DUE[state]
    return lines


# -- damage and faults -------------------------------------------------------------------------------

def damage(rows: DataFrame) -> DataFrame:
    """Conversations with faults: by a checksum of conv_id and turn a row is dropped (0 of 20), emptied (1), loses its
    `.!?` (2), comes twice (3) or is said by the user (4)."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    kind = (F.crc32(key.cast("binary")) % 20).alias("kind")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (spaced(rows).select("conv_id", "turn", "role", "text", kind).filter("kind <> 0")
            .select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.explode(copies).alias("copy")).drop("copy"))


def spaced(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       *(F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")))


def ordered(rows: DataFrame) -> DataFrame:
    """Rows as stored in order, with their place, the first place of their run (`begin`), and their role's and text's marks."""
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    ends = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = F.when(ends == "", 2).when(F.substring(ends, -1, 1).isin(".", "!", "?"), 0).otherwise(1)
    initial = F.substring("role", 1, 1)
    letter = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    found = spaced(rows).select(
        key_of("conv_id").alias("conv"), "conv_id", "turn", "role", "text", digest.alias("digest"),
        fault.cast("int").alias("fault"), letter.cast("int").alias("initial"),
        (F.length("role") + F.length("text")).cast("long").alias("chars"),
        F.monotonically_increasing_id().alias("row"))
    # Repeated rows are equal in all but `row`, by which ranges can part them.
    order = ["turn", F.substring("role", 1, KEY), F.substring("text", 1, KEY), "digest", "row"]
    return in_order(found, "conv", order, "repair-order", "chars", RUN, CHARS)


def words(rows: DataFrame) -> DataFrame:
    """One row per run of ordered rows: their letters, and their turns' least, greatest and number."""
    firsts = rows.groupBy("conv", "digest").agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first"))
    marked = rows.select("conv", "begin", "place", "turn", "fault", "initial").join(firsts, "place", "left")
    fault = F.when((F.col("fault") < 2) & F.col("first").isNull(), 3).otherwise(F.col("fault"))
    marked = marked.withColumn("letter", F.substring(F.lit(LETTERS), 4 * F.col("initial") + fault + 1, F.lit(1)))
    found = marked.groupBy("conv", "begin").agg(F.array_sort(F.collect_list(F.struct("place", "letter"))).alias("rows"),
                                                F.min("turn").alias("least"), F.max("turn").alias("most"),
                                                F.size(F.collect_set("turn")).alias("turns"))
    return found.select("conv", "begin", F.array_join(F.transform("rows", lambda r: r["letter"]), "").alias("word"),
                        "least", "most", "turns")


# -- repair ------------------------------------------------------------------------------------------

PLAN = ("conv string, conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
        "audit string, pieces array<struct<begin:long, state:int, letters:string, runs:int>>")
PIECES = pa.list_(pa.struct([("begin", pa.int64()), ("state", pa.int32()), ("letters", pa.string()), ("runs", pa.int32())]))


def plan(conversations: DataFrame) -> DataFrame:
    """Counts and edits of each conversation, from the words of its runs in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                runs = row["runs"] or []
                cost, pieces = cheapest([r["word"] for r in runs]) if runs else (0, [])
                word = "".join(r["word"] for r in runs)
                letters = np.frombuffer(word.encode("ascii"), np.uint8) - ord("A")
                faults = np.bincount(letters % 4, minlength=4).tolist()
                pairs = np.bincount(letters[:-1] // 4 * 4 + letters[1:] // 4, minlength=16)
                sound = sum(int(pairs[4 * INITIALS.index(a) + INITIALS.index(b)]) for a, b in SOUND)
                out.append((row["conv"], row["conv_id"], gaps(runs), faults[2], faults[3], faults[1],
                            int(pairs.sum()) - sound, cost, "".join(p for _, p in pieces),
                            [{"begin": r["begin"], "state": state, "letters": piece, "runs": len(runs)}
                             for r, (state, piece) in zip(runs, pieces)]))
            kinds = [pa.string(), *[pa.int64()] * 7, pa.string(), PIECES]
            names = [field.split()[0] for field in PLAN.split(", pieces")[0].split(", ")] + ["pieces"]
            columns = zip(*out) if out else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)
    return map_arrow(conversations, run, PLAN)


def gaps(runs: list[dict]) -> int:
    """Turn numbers missing between the least and the greatest; null turns do not count. A run may begin with the turn
    that the run before ends with."""
    known = [r for r in runs if r["most"] is not None]
    if not known:
        return 0
    numbers = sum(r["turns"] for r in known) - sum(a["most"] == b["least"] for a, b in zip(known, known[1:]))
    return known[-1]["most"] - known[0]["least"] + 1 - numbers


LINES = "conv string, begin long, runs int, digest string, lines binary"


def assemble(runs: DataFrame) -> DataFrame:
    """The repaired lines of each run: their digest where the conversation has no other run, else the lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1).to_pylist()[0]
                lines = repaired(row["state"], row["letters"], [(t["role"], t["text"]) for t in row["turns"]])
                raw = "\n".join(lines).encode("utf-8", "surrogatepass")
                alone = row["runs"] == 1
                columns = (row["conv"], row["begin"], row["runs"], hashlib.sha256(raw).hexdigest() if alone else None,
                           raw if lines and not alone else None)
                kinds = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(columns, kinds)],
                                                 [field.split()[0] for field in LINES.split(", ")])
    return map_arrow(runs, run, LINES)


def fold(runs: DataFrame) -> DataFrame:
    """(conv, digest) of conversations of several runs, whose lines are hashed in order, one run at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, sums, any_line = None, None, False
        for batch in batches:
            done = []
            for key, lines in zip(batch.column("conv").to_pylist(), batch.column("lines").to_pylist()):
                if key != conv:
                    if sums:
                        done.append((conv, sums.hexdigest()))
                    conv, sums, any_line = key, hashlib.sha256(), False
                if lines is not None:
                    sums.update(b"\n" + lines if any_line else lines)
                    any_line = True
            yield _digests(done)
        if sums:
            yield _digests([(conv, sums.hexdigest())])
    dealt = runs.select("conv", "begin", "lines").repartition("conv").sortWithinPartitions("conv", "begin")
    return map_arrow(dealt, run, "conv string, digest string")


def _digests(rows: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in (0, 1)], ["conv", "digest"])


def repair(original: DataFrame, damaged: DataFrame) -> DataFrame:
    """One row per conversation of `original`: faults, cost and edits of its rows in `damaged`, and what they come to."""
    rows = ordered(damaged)
    run = F.struct("begin", "word", "least", "most", "turns")
    runs = words(rows).groupBy("conv").agg(F.array_sort(F.collect_list(run)).alias("runs"))
    every = original.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.lit(0)).select(
        key_of("conv_id").alias("conv"), "conv_id")
    plans = store(plan(every.join(runs, "conv", "left")), "repair-plans")
    pieces = plans.select("conv", F.explode("pieces").alias("piece")).select("conv", "piece.*")
    texts = rows.groupBy("conv", "begin").agg(F.array_sort(F.collect_list(F.struct("place", "role", "text"))).alias("turns"))
    lines = store(assemble(texts.join(pieces, ["conv", "begin"])), "repair-lines")
    digests = (lines.filter("runs = 1").select("conv", "digest")
               .unionAll(fold(lines.filter("runs > 1"))))
    empty = F.lit(hashlib.sha256(b"").hexdigest())
    return plans.join(digests, "conv", "left").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.coalesce("digest", empty).alias("repaired_sha256"))
