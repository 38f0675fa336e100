"""Repair of conversations against a search over all edits, row by row."""

import hashlib
import random
import zlib

import pytest

from kerbside.llm import repair

WHITE = " \t\n\x0b\x0c\r"
COLUMNS = "conv_id long, turn long, role string, text string, audit string, place int"


def least(rows):
    """(cost, letters, lines) of rows (role, text, fault), by a plain search that keeps the best way into each state."""
    def put_in(ways):
        for _ in range(3):
            for state, (to, role) in {0: (2, "user"), 1: (2, "user"), 2: (3, "assistant"), 3: (2, "user")}.items():
                if state in ways:
                    cost, letters, lines = ways[state]
                    found = (cost + 3, letters + "I", [*lines, f"{role}:"])
                    ways[to] = min(ways.get(to, found), found)
        return ways

    ways = put_in({0: (0, "", [])})
    for role, text, fault in rows:
        after = {}
        for state, (cost, letters, lines) in ways.items():
            options = [(state, 4, "D", [])]
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                kept = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}.get((state, role[:1]))
                if kept:
                    options.append((kept, more, "K", [f"{role}:{text}"]))
                due = "assistant" if state == 2 else "user"
                options.append((3 if state == 2 else 2, 3 + more, "R", [f"{due}:{text}"]))
            for to, extra, letter, line in options:
                found = (cost + extra, letters + letter, lines + line)
                after[to] = min(after.get(to, found), found)
        ways = put_in(after)
    return min(ways[s] for s in (0, 3) if s in ways)


def damaged(rows):
    for conv_id, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv_id, turn))
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        if kind == 4:
            role = "user"
        if kind:
            yield from [(conv_id, turn, role, text)] * (2 if kind == 3 else 1)


def expected(rows):
    found = {}
    after = list(damaged(rows))
    for conv_id in {r[0] for r in rows}:
        own = sorted(((t is not None, t, role, text) for c, t, role, text in after if c == conv_id))
        seen, marked = set(), []
        for _, _, role, text in own:
            body = text.rstrip(WHITE)
            fault = ("blank" if not body else "duplicate" if (role, text) in seen
                     else "" if body[-1] in ".!?" else "truncated")
            seen.add((role, text))
            marked.append((role, text, fault))
        turns = [t for known, t, *_ in own if known]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(own, own[1:])]
        cost, letters, lines = least(marked)
        found[conv_id] = (gaps, *(sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")),
                          sum(p not in ("su", "ua", "au") for p in pairs), cost, letters,
                          hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return found


def found(spark, rows):
    frame = spark.createDataFrame([(*r, "clash", 1) for r in rows], COLUMNS).repartition(5)
    return {r[0]: tuple(r)[1:] for r in repair.repair(frame, repair.damage(frame)).collect()}


def conversations(seed, n):
    pick = random.Random(seed)
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", None, "User"]
    texts = ["Yes.", "no", "Why?!", " \n", "", None, "end. \t", "été!", "...", "a", "b.", "long. " * 300]
    rows = []
    for conv_id in [None, *range(n)]:
        for turn in range(pick.choice([1, 2, 3, 5, 9, 30])):
            rows.append((conv_id, pick.choice([turn, turn, turn, turn + 3, None]), pick.choice(roles), pick.choice(texts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed):
    rows = conversations(seed, 60)
    assert found(spark, rows) == expected(rows)


def test_runs_are_put_together(spark, monkeypatch):
    """Conversations cut into runs of a few rows or characters give the same."""
    rows = conversations(3, 12) + [(99, i // 2, random.Random(i).choice(["user", "assistant"]), f"Text {i % 90}.")
                                   for i in range(400)]
    monkeypatch.setattr(repair, "RUN", 7)
    monkeypatch.setattr(repair, "CHARS", 900)
    assert found(spark, rows) == expected(rows)


def test_edge_rows(spark):
    rows = [(1, 0, "user", "x" * 300_000 + "."), (1, 1, "assistant", " " * 1_200_000), (1, 1, "assistant", "\n" * 1_200_000 + "a"),
            (2, None, None, None), (3, None, "system", "Only."), (4, 5, "user", "hi.")] * 2
    assert found(spark, rows) == expected(rows)


def test_all_rows_dropped(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    assert found(spark, [(gone, 0, "user", "Hi.")]) == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


def test_empty_table(spark):
    assert found(spark, []) == {}


def test_blocks_as_rows():
    """Sweeping by blocks gives the vectors of single rows, for every block and vector."""
    table = repair.tables()
    pick = random.Random(5)
    for _ in range(3000):
        block = [pick.randrange(repair.CLASSES) for _ in range(repair.BLOCK)]
        behind = pick.randrange(len(table.vectors))
        vector = table.vectors[behind]
        for symbol in reversed(block):
            vector = repair.before_row(symbol, vector)
        code = sum(s * repair.CLASSES ** k for k, s in enumerate(reversed(block)))
        cost = int(table.cost[code, behind])
        assert tuple(c + cost for c in table.vectors[table.vector[code, behind]]) == vector
