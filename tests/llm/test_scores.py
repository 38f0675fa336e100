"""Token counts, language-model scores, vectors, fingerprints and chat against the libraries and brute force."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from edges import LONG, documents, edge_frame, edge_rows, empty_frame
from tokenizers import Tokenizer, models, pre_tokenizers

from kerbside.llm import chat, counts, phrases, ppm, vectors
from kerbside.llm.common import checksum
from kerbside.llm.queries import QUERIES


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


# -- token counts ------------------------------------------------------------------------------------

def unigram(vocab, fallback):
    library = Tokenizer(models.Unigram(vocab, unk_id=0, byte_fallback=fallback))
    library.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return library


def test_counts_as_library(spark, sf_dir):
    library = unigram(counts.model_vocab("piece_bpe_32k.model"), True)
    texts = documents(spark, sf_dir)
    rows = QUERIES["op4_token_counts"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_chars, r.n_tokens) for r in rows} == {
        i: (len(text), len(library.encode(text, add_special_tokens=False).ids)) for i, text in texts.items()}
    odd = ["a  b", "  a", "日本語 𝔘 ok", "▁a", "a▁b", " ▁b", "▁▁x", "<unk> <s>", "\x00\x01", "a" * 3000]
    counter = counts.model_counter("piece_bpe_32k.model")
    assert [counter.count(text) for text in odd] == [len(library.encode(text).ids) for text in odd]


@pytest.mark.parametrize("seed", range(10))
def test_ties_of_random_vocabularies(seed):
    pick = random.Random(seed)
    vocab = dict([("<unk>", 0.0)] + [("".join(pick.choices("ab▁c", k=pick.randint(1, 4))), -float(pick.randint(1, 4)))
                                     for _ in range(14)])
    library, counter = unigram(list(vocab.items()), False), counts.UnigramCounter(list(vocab.items()), False)
    for _ in range(400):
        text = "".join(pick.choices("abcd ", k=pick.randint(0, 14)))
        assert counter.count(text) == len(library.encode(text).ids), text


def test_count_edges(spark):
    rows = counts.count_tokens(edge_frame(spark)).collect()
    assert len(rows) == len(edge_rows()) and {r.n_tokens for r in rows if r.doc_id in (0, 1)} == {0}
    assert counts.count_tokens(empty_frame(spark)).count() == 0


# -- language-model scores ---------------------------------------------------------------------------

def tokens_of(text):
    return [*re.findall(rb"[^\x20\x09-\x0D]+", text.encode().lower()), b""]


def symbols_of(text):
    return [ppm.START] * ppm.ORDER + [b + 1 for b in b" ".join(tokens_of(text)[:-1])] + [ppm.START]


class SlowModel:
    """Prediction by partial matching with exclusion and update exclusion, from a list of texts, symbol by symbol."""

    def __init__(self, texts):
        self.seen = [{} for _ in range(ppm.ORDER + 1)]  # context -> symbol -> count, by length of context
        for text in texts:
            symbols = symbols_of(text)
            for i in range(ppm.ORDER, len(symbols)):
                for k in range(ppm.ORDER, -1, -1):
                    known = self.seen[k].setdefault(tuple(symbols[i - k:i]), Counter())
                    known[symbols[i]] += 1
                    if known[symbols[i]] > 1:
                        break  # shorter contexts have counted it when this one first saw it

    def chance(self, before, symbol):
        chance, excluded = 1.0, set()
        for k in range(ppm.ORDER, -1, -1):
            known = self.seen[k].get(tuple(before[len(before) - k:]))
            if not known:
                continue
            left = {s: n for s, n in known.items() if s not in excluded}
            n, q = sum(left.values()), len(left)
            if symbol in left:
                return chance * (2 * left[symbol] - 1) / (2 * n)
            chance *= q / (2 * n) if n else 1
            excluded |= set(known)
        return chance / max(1, ppm.SYMBOLS - len(excluded))

    def log10(self, text):
        symbols = symbols_of(text)
        return sum(math.log10(self.chance(symbols[i - ppm.ORDER:i], symbols[i])) for i in range(ppm.ORDER, len(symbols)))


def test_chances_add_up_to_one():
    model = SlowModel(["ab ab abc", "the cat", "the cab"])
    for before in (b"the c", b"zzzzz", b" ab a", b"ab ab"):
        known = [b + 1 for b in before]
        assert sum(model.chance(known, s) for s in range(1, 258)) == pytest.approx(1, abs=0.02)


def test_scores_as_brute_force(spark, sf_dir):
    """At the registered parameters, over the whole table: counts, base and the score of every text."""
    texts = documents(spark, sf_dir)
    train = {i: text for i, text in texts.items() if checksum(i) % 7 != 2}
    seen = Counter(t for text in train.values() for t in tokens_of(text))
    n, v = sum(seen.values()), len(seen)
    rows = {r.doc_id: r for r in QUERIES["op6_lm_scoring"](spark, sf_dir).collect()}
    assert set(rows) == set(texts)
    model = SlowModel(train.values())
    for i, text in texts.items():
        tokens = tokens_of(text)
        assert (rows[i].held_out, rows[i].n_tokens, rows[i].n_known, rows[i].train_tokens) == (
            i not in train, len(tokens), sum(t in seen for t in tokens), n)
        assert rows[i].base_score == pytest.approx(sum(math.log10((seen[t] + 1) / (n + v + 1)) for t in tokens))
        assert rows[i].score == pytest.approx(model.log10(text))


def test_blocks_and_steps_do_not_matter(spark, monkeypatch):
    """Small blocks, texts cut into steps, bytes of all values, and texts with nothing known."""
    pick = random.Random(7)
    texts = {i: " ".join("".join(pick.choices("abcdé日", (5, 3, 1, 1, 1, 1), k=pick.randint(1, 5))) for _ in range(50))
             for i in range(60)}
    texts |= {100: "", 101: " \n", 102: "ZZZ zzz \x00", 103: "ABCD  abcd\tAbcD " * 40, 104: "Ж" * 500}
    frame = spark.createDataFrame([*texts.items(), (None, texts[0])], "doc_id long, text string").repartition(4)
    model = SlowModel([text for i, text in texts.items() if checksum(i) % 7 != 2] + [texts[0]])
    expected = {i: pytest.approx(model.log10(text)) for i, text in texts.items()} | {None: pytest.approx(model.log10(texts[0]))}
    for block, step, held in ((2000, 64, 500), (1 << 25, 1 << 20, 1 << 22)):
        monkeypatch.setattr(ppm, "BLOCK", block)
        monkeypatch.setattr(ppm, "STEP", step)
        monkeypatch.setattr(ppm, "HELD", held)
        assert {r.doc_id: r.score for r in ppm.score_documents(frame).collect()} == expected


@pytest.mark.parametrize("tables, spare", [(8, 4), (1, 1), (0, 4)])
def test_values_are_looked_up_by_tables(monkeypatch, tables, spare):
    monkeypatch.setattr(ppm, "TABLES", tables)
    monkeypatch.setattr(ppm, "SPARE", spare)
    draw = np.random.default_rng(3)
    keys = np.unique(np.concatenate([draw.integers(-(1 << 63), 1 << 62, 20_000), np.arange(5000) << 45, [-1, 0, 1]]))
    draw.shuffle(keys)
    values = draw.normal(size=len(keys)).astype(np.float32)
    asked = draw.integers(0, len(keys), 100_000)
    found = ppm.Lookup(keys, values)
    assert np.array_equal(found(keys[asked]), values[asked].astype(np.float64))
    assert tables != 8 or not len(found.keys)  # no key is left to a search
    assert len(found(keys[:0])) == 0 and ppm.Lookup(keys[:1], values[:1])(keys[:1])[0] == values[0]


def test_keys_are_counted_as_they_come(monkeypatch):
    monkeypatch.setattr(ppm, "HELD", 50)
    draw, counted, expected = random.Random(4), ppm._Counted(), Counter()
    for _ in range(200):
        part, train = [draw.randrange(-300, 300) for _ in range(draw.randrange(30))], draw.random() < 0.5
        counted.add(np.array(part, np.int64), train)
        for key in part:
            expected[key] += train
    counted.fold()
    assert dict(zip(counted.keys.tolist(), counted.n.tolist())) == dict(expected)
    assert (np.diff(counted.keys) > 0).all()


def test_order_of_words_counts(spark):
    """A text and its words shuffled have one base score and different scores; fluent ones score higher."""
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").filter("length(text) > 400").collect()
    texts = {r.doc_id: r.text for r in rows}
    held = [i for i in texts if checksum(i) % 7 == 2][:40]
    pick = random.Random(3)
    free = iter(i for i in range(10 ** 6, 2 * 10 ** 6) if checksum(i) % 7 == 2)
    mixed = {}
    for i in held:
        words = texts[i].split()
        pick.shuffle(words)
        mixed[i] = (next(free), " ".join(words))
    frame = spark.createDataFrame([*texts.items(), *mixed.values()], "doc_id long, text string")
    found = {r.doc_id: r for r in ppm.score_documents(frame).collect()}
    pairs = [(found[i], found[other]) for i, (other, _) in mixed.items()]
    assert all(a.base_score == pytest.approx(b.base_score) and a.score != b.score for a, b in pairs)
    assert np.mean([a.score > b.score for a, b in pairs]) > 0.9


def test_held_out_score_beats_the_base(spark):
    held = [r for r in QUERIES["op6_lm_scoring"](spark, "/root/testdata/sf0.1").collect() if r.held_out]
    assert sum(r.score for r in held) > 0.97 * sum(r.base_score for r in held)


def test_score_edges(spark):
    rows = ppm.score_documents(edge_frame(spark)).collect()
    assert len(rows) == len(edge_rows()) and all(r.score < 0 and r.n_tokens > 0 for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    assert ppm.score_documents(empty_frame(spark)).count() == 0
    nobody = spark.createDataFrame([(i, "a b") for i in range(200) if checksum(i) % 7 == 2], "doc_id long, text string")
    assert all(r.train_tokens == 0 and r.n_known == 0 and r.score < 0 for r in ppm.score_documents(nobody).collect())


# -- vectors -----------------------------------------------------------------------------------------

def brute_vectors(rows, threshold=0.93):
    usable = [(i, x / np.linalg.norm(x), label) for i, v, label in rows if v is not None and label is not None
              and None not in v and len(x := np.array(v, float)) and np.isfinite(x).all() and x.any()]
    links = {i: set() for i, _, _ in rows}
    for k, (i, x, a) in enumerate(usable):
        for j, y, b in usable[k + 1:]:
            if a == b and len(x) == len(y) and x @ y >= threshold:
                links[i].add(j)
                links[j].add(i)
    component = {}
    for i in sorted(links):
        if i not in component:
            reach = [i]
            for j in reach:
                if j not in component:
                    component[j] = i
                    reach += links[j]
    return {i: (len(links[i]), component[i], component[i] == i) for i in links}


def test_vectors_as_brute_force(spark, monkeypatch):
    """Several cells and tiles, groups across cells, copies, and vectors without direction."""
    monkeypatch.setattr(vectors, "CELL", 40)
    monkeypatch.setattr(vectors, "TILE", 32)
    pick, rows = np.random.default_rng(3), []
    for label in (0, 1, 2):
        for _ in range(25 if label else 60):
            base = pick.normal(size=4)
            for _ in range(pick.integers(1, 6)):
                rows.append((len(rows), (base + pick.normal(size=4) * 0.35).tolist(), label))
    rows += [(len(rows) + k, rows[3][1], 0) for k in range(70)]
    n = len(rows)
    rows += [(n, None, 0), (n + 1, [0.0] * 4, 0), (n + 2, [1.0, None, 1.0, 1.0], 0), (n + 3, [math.nan] * 4, 0),
             (n + 4, [math.inf, 0.0, 0.0, 1.0], 0), (n + 5, rows[3][1], None), (n + 6, [1.0], 0), (n + 7, [], 0),
             (n + 8, [1e300] * 4, 0), (n + 9, [1e-300] * 4, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: tuple(r)[1:] for r in vectors.near_duplicates(frame).collect()}
    big = [r for r in rows if r[0] < n + 8 or True]
    small = [(i, [1.0] * 4 if i in (n + 8, n + 9) else v, label) for i, v, label in big]
    assert found == brute_vectors(small)


def test_vector_edges(spark):
    frame = spark.createDataFrame([(None, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (5, [2.0, 0.0], 1), (None, None, None)],
                                  "vec_id long, embedding array<float>, label int")
    rows = sorted(map(tuple, vectors.near_duplicates(frame).collect()), key=str)
    assert rows == [(5, 2, 5, True), (5, 2, 5, True), (None, 0, None, True), (None, 2, None, True)]
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


def test_an_id_with_several_vectors(spark):
    """Rows count their own vector's links; components are of ids."""
    pick, rows = np.random.default_rng(4), []
    for label in (0, 1):
        for _ in range(12):
            base = pick.normal(size=4)
            rows += [(int(pick.integers(0, 40)), (base + pick.normal(size=4) * 0.3).tolist(), label) for _ in range(3)]
    rows += rows[:2] + [(7, None, 0), (rows[0][0], [0.0] * 4, 0), (None, rows[5][1], 0)]
    units = [None if v is None or not np.any(v) else np.array(v) / np.linalg.norm(v) for _, v, _ in rows]
    links, component = [0] * len(rows), {i: i for i, _, _ in rows if i is not None}
    for a, (i, _, label) in enumerate(rows):
        for b, (j, _, other) in enumerate(rows):
            if a != b and label == other and units[a] is not None and units[b] is not None and units[a] @ units[b] >= 0.93:
                links[a] += 1
                if i is not None and j is not None:
                    low, high = sorted((component[i], component[j]))
                    component = {k: low if c == high else c for k, c in component.items()}
    expected = sorted(((i, n, None if i is None else component[i] if u is not None else i,
                        i is None or (component[i] if u is not None else i) == i)
                       for (i, _, _), n, u in zip(rows, links, units)), key=str)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").repartition(3)
    assert sorted(map(tuple, vectors.near_duplicates(frame).collect()), key=str) == expected


def test_sample_of_a_label_is_cut_before_it_is_sorted(spark):
    """The rank is over what a bound on the hash lets through."""
    classes = spark.range(50_000).select(F.lit(1).cast("long").alias("label"), F.lit(2).alias("dim"), F.col("id").alias("node"),
                                         F.xxhash64("id").alias("mark"), F.lit(1).cast("long").alias("copies"),
                                         F.lit(np.array([1.0, 0.0]).tobytes()).alias("unit"))
    found = vectors.fit_cells(classes)
    assert found[1, 2].shape == (50_000 // vectors.CELL, 2)


# -- fingerprints ------------------------------------------------------------------------------------

def test_fingerprints_with_next(spark, sf_dir):
    texts = documents(spark, sf_dir)
    order = sorted(texts, reverse=True)
    rows = {r.doc_id: r for r in QUERIES["op10_fingerprints"](spark, sf_dir).collect()}
    assert set(rows) == set(texts)
    for i, following in zip(order, [*order[1:], order[0]]):
        edited = phrases.edit(texts[i], texts[following])
        own, other, then = (phrases.fingerprints([t])[0] for t in (texts[i], edited, texts[following]))
        assert tuple(rows[i])[1:5] == (len(texts[i]), digest(edited), own, other)
        assert tuple(rows[i])[5:] == (phrases.likeness(own, other), phrases.likeness(own, then))
    near = [(r.near_edited, r.near_next) for r in rows.values() if r.n_chars > 300]
    assert np.mean([a for a, _ in near]) > 0.4 and np.mean([b for _, b in near]) < 0.1
    assert np.mean([a > b for a, b in near]) > 0.95


@pytest.mark.parametrize("seed", range(5))
def test_equal_stretches_are_cut_alike(seed):
    """Whatever stands before and after, phrases inside an equal stretch are the same."""
    pick = random.Random(seed)
    text = lambda n: "".join(pick.choices("abcde \n", k=n))
    shared = text(900)

    def names(whole):
        symbols = np.frombuffer(whole.encode("utf-32-le"), "<u4")
        first = np.arange(len(symbols)) == 0
        found = []
        for _ in range(3):
            symbols, first = phrases.next_level(symbols, first)
            found.append(symbols.tolist())
        return found

    whole = names(shared)
    moved = names(text(pick.randint(1, 60)) + shared + text(50))
    for level, (a, b) in enumerate(zip(whole, moved)):
        inside = a[8:-8]
        assert any(b[k:k + len(inside)] == inside for k in range(len(b))), level


FULL = (1 << 64) - 1


def slow_mix(x):
    x = (x ^ (x >> 32)) * 0x9E3779B97F4A7C15 & FULL
    x = (x ^ (x >> 29)) * 0xBF58476D1CE4E5B9 & FULL
    return x ^ (x >> 32)


def slow_level(symbols):
    """Phrase names of one sequence, symbol by symbol."""
    odd, runs = 0x94D049BB133111EB, []
    for s in symbols:
        if runs and runs[-1][0] == s:
            runs[-1][1] += 1
        else:
            runs.append([s, 1])
    line = [s if n == 1 else slow_mix((s + n * odd) & FULL) for s, n in runs]

    def toss(before, here):
        apart = before ^ here
        place = min(63, (apart & -apart).bit_length() - 1)
        return 2 * place + (here >> place & 1)
    labels = line
    for _ in range(5):
        labels = [toss(labels[i - 1] if i else here ^ 1, here) for i, here in enumerate(labels)]
    phrases_found = []
    for i, s in enumerate(line):
        rises = i > 0 and labels[i] > labels[i - 1]
        falls = i + 1 == len(line) or labels[i + 1] <= labels[i]
        if i == 0 or rises and falls:
            phrases_found.append([])
        phrases_found[-1].append(s)
    return [slow_mix(sum(slow_mix(s) * pow(odd, k + 1, 1 << 64) for k, s in enumerate(p)) & FULL) for p in phrases_found]


def slow_fingerprint(text):
    """The 40 smallest of each of three levels' names, cut to 32 bits."""
    found, symbols = [], [ord(c) for c in text]
    for _ in range(3):
        symbols = slow_level(symbols) if symbols else []
        found.append("".join(f"{name:08x}" for name in sorted({s & 0xFFFFFFFF for s in symbols})[:40]))
    return ".".join(found) if text else ""


def slow_likeness(a, b):
    """Dice share, on the highest level with 12 names on both sides, of what both lists can hold."""
    if not a or not b:
        return float(a == b)
    sides = [[[part[k:k + 8] for k in range(0, len(part), 8)] for part in f.split(".")] for f in (a, b)]
    level = max([k for k in range(3) if all(len(side[k]) >= 12 for side in sides)], default=0)
    x, y = sides[0][level], sides[1][level]
    reach = min([names[-1] for names in (x, y) if len(names) == 40], default="g")
    x, y = [n for n in x if n <= reach], [n for n in y if n <= reach]
    return 2 * len(set(x) & set(y)) / (len(x) + len(y))


def test_fingerprints_as_slow_version(spark, sf_dir):
    texts = [*documents(spark, sf_dir).values()][:120] + ["", "a", "aa", "ab", "aab" * 50, LONG, "Où ça? 日本 𝔘", "x" * 3000]
    own = phrases.fingerprints(texts)
    assert own == [slow_fingerprint(text) for text in texts]
    pairs = [(a, b) for a in own[:40] for b in own[-20:]] + [(a, a) for a in own]
    assert [phrases.likeness(a, b) for a, b in pairs] == pytest.approx([slow_likeness(a, b) for a, b in pairs])


def test_names_of_unrelated_texts_rarely_meet(spark):
    """Names are cut to 32 bits. Of all names in unrelated texts, equal ones with different full names are as rare as chance."""
    texts = [t for t in documents(spark, "/root/testdata/sf0.01").values() if t][:600]
    full = {}
    for text in texts:
        symbols = np.frombuffer(text.encode("utf-32-le"), "<u4")
        first = np.arange(len(symbols)) == 0
        for _ in range(3):
            symbols, first = phrases.next_level(symbols, first)
            for s in np.unique(symbols).tolist():
                full.setdefault(s & 0xFFFFFFFF, set()).add(s)
    names = sum(map(len, full.values()))
    met = sum(len(s) - 1 for s in full.values())
    assert met <= 3 + 3 * names ** 2 / 2 ** 33


def test_fingerprints_do_not_depend_on_the_batch():
    texts = ["", "a", "aaaa", "ab" * 300, LONG, "Où ça? 日本", *[f"text {i} of some" * i for i in range(30)]]
    alone = [phrases.fingerprints([t])[0] for t in texts]
    assert phrases.fingerprints(texts) == alone and phrases.fingerprints(texts[::-1]) == alone[::-1]
    assert phrases.likeness("", "") == 1 and phrases.likeness("", alone[1]) == 0


def test_fingerprint_edges(spark):
    rows = phrases.fingerprints_with_next(edge_frame(spark)).collect()
    assert len(rows) == len(edge_rows())
    by_id = {r.doc_id: r for r in rows}
    assert by_id[0].n_chars == 0 and by_id[0].edited_sha256 == digest("") and by_id[0].near_edited == 1
    # Rows without id come last, the longer text first; after the last one comes the first.
    assert sorted(r.n_chars for r in rows if r.doc_id is None) == [0, 5]
    assert phrases.fingerprints_with_next(empty_frame(spark)).count() == 0
    one = spark.createDataFrame([(1, "abcd")], "doc_id long, text string")
    assert phrases.fingerprints_with_next(one).first().edited_sha256 == digest("abab")


# -- chat --------------------------------------------------------------------------------------------

CONTROLS = ["<|turn|>", "<|text|>", "<|end|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\\", "<", "|",
            ">", "[", "/", "s", "x", "é", "<|endoftext|>", "INST]", "\n", " "]


@pytest.mark.parametrize("seed", range(4))
def test_escape_is_reversible(seed):
    pick = random.Random(seed)
    for _ in range(3000):
        text = "".join(pick.choices(CONTROLS, k=pick.randint(0, 9)))
        escaped = chat.escape(text)
        assert chat.unescape(escaped) == text and not chat.CONTROL.search(escaped)
        turns = [("user", text), (text, "b")]
        assert chat.parse("".join(chat.TURN + chat.escape(r) + chat.TEXT + chat.escape(t) + chat.END
                                  for r, t in turns)) == turns


def test_shared_turns_are_written_once(spark, monkeypatch):
    pick, rows = random.Random(2), []
    for conv in range(300):
        first = "the same question" if conv % 3 else f"question {conv}"
        turns = [("system", "be kind"), ("user", first), ("assistant", f"answer {pick.randint(0, 3)} </s>")]
        turns += [("user", pick.choice("abc")), ("assistant", pick.choice("de"))][:2 * pick.randint(0, 1)]
        rows += [(conv, k, role, text) for k, (role, text) in enumerate(turns)]
    pick.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    blocks = chat.format_conversations(frame.coalesce(1)).collect()
    paths = set()
    for conv in range(300):
        turns = [(r, t) for _, _, r, t in sorted((r for r in rows if r[0] == conv), key=lambda r: r[1])]
        paths |= {tuple(turns[:k + 1]) for k in range(len(turns))}
    segments = sum(len(b.segments) for b in blocks)
    # Blocks begin anew, and may write a beginning once more.
    assert len(paths) <= segments <= len(paths) + 6 * len(blocks)
    for b in blocks:
        for s in b.segments:
            above = sum(a.stop - a.start for a in s.attends)
            assert list(b.positions[s.start:s.stop]) == list(range(above, above + s.stop - s.start))
            assert all(a.stop <= s.start for a in s.attends)
            if s.parent >= 0:
                up = b.segments[s.parent]
                assert above == sum(a.stop - a.start for a in up.attends) + up.stop - up.start
    assert {r.conv_id for r in chat.read_back(chat.format_conversations(frame)).collect()} == set(range(300))


def test_long_conversations_are_cut(spark):
    """Conversations of a third of the rows, one of them without id, come in bounded blocks and back whole."""
    pick = random.Random(6)
    rows = [(None if k % 2 else 9, k // 7, pick.choice(["user", "assistant"]), f"turn {pick.randint(0, 99)} " * 12)
            for k in range(9000)]
    rows += [(100 + k // 2, k % 2, "user", f"q {k}") for k in range(2000)]
    pick.shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    blocks = chat.format_conversations(frame).collect()
    assert max(len(b.ids) for b in blocks) < 2 * chat.BLOCK and max(len(b.segments) for b in blocks) <= 8192
    for conv in (None, 9):
        runs = sorted((b.leaves[0].run, b.leaves[0].first, len(b.ids)) for b in blocks if b.leaves[0].runs > 1
                      and b.leaves[0].conv_id == conv)
        assert len(runs) > 1 and [r for r, _, _ in runs] == list(range(len(runs)))
        assert [first for _, first, _ in runs] == [sum(n for _, _, n in runs[:k]) for k in range(len(runs))]
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(frame)).collect()}
    assert len(found) == 1002
    for conv in (None, 9, 100):
        turns = sorted(r[1:] for r in rows if r[0] == conv)
        learned = "".join(text for _, role, text in turns if role == "assistant")
        assert found[conv].turns_sha256 == digest("".join(f"{role}\n{text}\n" for _, role, text in turns))
        assert (found[conv].n_turns, found[conv].loss_chars) == (len(turns), len(learned))
        assert found[conv].loss_sha256 == digest(learned)
        assert found[conv].formatted_chars == sum(23 + len(role) + len(text) for _, role, text in turns)


def test_chat_with_long_white_space(spark):
    """In a short conversation and in one that is cut into runs."""
    blank = "x" + " \n" * 600_000
    rows = [(1, 0, "user", " " * 200_000), (2, 0, "user", blank), (2, 1, "assistant", blank + "y"), (None, 0, "\t" * 120_000, "a")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(frame)).collect()}
    for conv in (1, 2, None):
        assert found[conv].turns_sha256 == digest("".join(f"{role}\n{text}\n" for c, _, role, text in rows if c == conv))


def test_chat_edges(spark):
    rows = [(1, 0, None, None), (1, None, "user", "a"), (1, 1, "assistant", ""), (2, 0, "assistant", LONG),
            (2, 0, "assistant", LONG), (None, 0, "user", "nobody"), (3, 5, "<|end|>", "é\\"), (3, 4, "assistant", "\\<s>")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows],
                                  "conv_id long, turn long, role string, text string, n_turns int, path string")
    found = {r.conv_id: r for r in chat.read_back(chat.format_conversations(frame)).collect()}
    assert found[1].turns_sha256 == digest("user\na\n\n\nassistant\n\n") and found[1].loss_chars == 0
    assert found[2].n_turns == 2 and found[2].loss_sha256 == digest(LONG * 2)
    assert found[3].turns_sha256 == digest("assistant\n\\<s>\n<|end|>\né\\\n") and found[3].loss_sha256 == digest("\\<s>")
    assert found[None].n_turns == 1
    assert chat.format_conversations(frame.limit(0)).count() == 0
