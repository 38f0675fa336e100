"""Byte-pair automaton and packing against the tokenizers library and brute force."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from edges import documents
from tokenizers import Tokenizer
from tokenizers.models import BPE

from kerbside.llm import bpe, packing

ODD = [None, "", " ", "\n", "a", " a", "a  b", "a\n b", "x <|endoftext|> y", "pre<|startoftext|>POST", "é ü\tb c",
       "don't  'll x.\n\ny", "a\x1c b", "a \x85b", "日本 語。 ok", "１２ ½ Ⅷ", "é É", "ΣΑΣ", "İstanbul ŉ ǆ",
       "a" * 23, "hahahahahaha", "!!!!!!!", "x" * 5000, "tail ", "one. two! three?\n" * 400]


def frame(spark, texts):
    return spark.createDataFrame([(i, text, "clash") for i, text in enumerate(texts)],
                                 "doc_id long, text string, n_tokens string")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_bpe_as_library(spark, sf_dir):
    from kerbside.llm.queries import QUERIES
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))

    def expected(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        return (len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False)))

    found = bpe.encode_documents(frame(spark, ODD), keep=True).collect()
    assert len(found) == len(ODD)
    for row in found:
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == expected(ODD[row.doc_id])
        assert len(row.ids) == row.n_tokens and digest(row.decoded) == row.decoded_sha256
    texts = documents(spark, sf_dir)
    rows = QUERIES["op1_bpe"](spark, sf_dir).collect()
    assert {r.doc_id: tuple(r[1:4]) for r in rows} == {i: expected(text) for i, text in texts.items()}


@pytest.mark.parametrize("seed", range(8))
def test_automaton_on_random_merges(seed):
    """Small alphabets bring out overlapping merges such as (a, a)."""
    pick = random.Random(seed)
    vocab, merges = {c: i for i, c in enumerate("abc")}, []
    while len(merges) < 25:
        u, v = pick.choice(list(vocab)), pick.choice(list(vocab))
        if u + v not in vocab and len(u + v) < 9:
            merges.append((u, v))
            vocab[u + v] = len(vocab)
    automaton, library = bpe.Automaton(vocab, merges), Tokenizer(BPE(vocab, merges))
    for _ in range(2000):
        word = "".join(pick.choices("abc", (6, 2, 1), k=pick.randint(1, 24)))
        assert automaton.encode(word) == library.encode(word).ids


def test_a_token_made_twice_is_refused():
    with pytest.raises(ValueError):
        bpe.Automaton({"a": 0, "b": 1, "ab": 2, "ba": 3, "aba": 4},
                      [("a", "b"), ("b", "a"), ("ab", "a"), ("a", "ba")])


def check_pieces(rows, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        ids = np.array([*library.encode(texts[doc_id] or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids)) and r.length > 0
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= 2048 and {r.sequence_tokens for r in pieces} == {at}
        padding += 0 if at & (at - 1) == 0 else 2048 - at
        total += at
    return padding / total


def test_pieces_cover_each_document(spark, sf_dir):
    from kerbside.llm.queries import QUERIES
    texts = documents(spark, sf_dir)
    assert check_pieces(QUERIES["op2_packing"](spark, sf_dir).collect(), texts) < 0.05
    check_pieces(packing.pack(frame(spark, ODD)).collect(), dict(enumerate(ODD)))


def test_documents_span_blocks(spark, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 700)
    encoder = packing.byte_encoder("byte_bpe_50k.json")
    block = packing._Block(0)
    for i, text in enumerate(ODD):
        block.add(i, np.append(encoder.ids(text or ""), np.uint32(1)).astype("<u4"), 0, 1, encoder.ends_sentence)
    pieces = list(block.pieces(512))
    assert sum(p[2] for p in pieces) == block.size and max(p[7] for p in pieces) <= 512


def test_every_sentence_end_may_be_a_cut():
    ids = np.array([5, 6, 7] * 40 + [1])
    places, penalty = packing.cut_places(ids, np.arange(10) == 7)
    # The end token is not parted from the last sentence.
    assert places.tolist() == [*range(3, 120, 3), 121]
    assert penalty.tolist() == [packing.SENTENCE_CUT] * 39 + [0.0]


@pytest.mark.parametrize("least", [1, 16, packing.LEAST_POWER])
@pytest.mark.parametrize("seed", range(12))
def test_cuts_are_cheapest(seed, least, monkeypatch):
    monkeypatch.setattr(packing, "LEAST_POWER", least)
    pick = np.random.default_rng(seed)
    places = np.cumsum(pick.integers(1, 40, 40))
    penalty = pick.choice([0.0, 1.0, 24.0], 40)
    length = 64
    powers = [1 << k for k in range(length.bit_length())]

    def cost(cuts):
        of = dict(zip(places.tolist(), penalty))
        total = 0.0
        for a, b in zip(cuts, cuts[1:]):
            assert b - a <= length
            own_size = b - a in powers and (b - a >= least or b == places[-1])
            total += of[b] + packing.SEQUENCE + (0 if own_size else length - b + a)
        return total

    spots = [0, *places.tolist()]
    best = {0: 0.0}
    for j in spots[1:]:
        best[j] = min(best[i] + cost([i, j]) for i in spots if 0 < j - i <= length)
    assert cost(packing.best_cuts(places, penalty, length)) == pytest.approx(best[spots[-1]])


BLANK = [" " * 1_200_000, "\n" * 1_200_000 + "a", "x" + "\t \n" * 400_000, "a" + " " * 60_000 + "b <|endoftext|> c", "\u3000" * 1_100_000]


def test_long_white_space(spark):
    """Ids are those of the library, and plain ids decode to the text."""
    check_pieces(packing.pack(frame(spark, BLANK)).collect(), dict(enumerate(BLANK)))
    encoder = packing.byte_encoder("byte_bpe_50k.json")
    assert all(encoder.coder.decode(encoder.plain_ids(text)) == text for text in BLANK + [t for t in ODD if t])


@pytest.mark.parametrize("build", [bpe.encode_documents, packing.pack])
def test_empty_table(spark, build):
    assert build(frame(spark, [])).count() == 0
