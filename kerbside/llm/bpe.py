"""Byte-pair encoding by a deterministic automaton that is compiled from the merges, and decoding by its arc labels.

The automaton reads tokens: a sequence of tokens is accepted if and only if it is the encoding of its text. It is
built by one gadget per merge, in order of rank. The gadget of (u, v) -> m takes the arc v away from the state that
follows u, and adds an arc m wherever u and then v could be read; the state after m starts as a copy of the state
after v. States so differ only in the arcs that are gone, hence no arc is stored: `Automaton.arc` tells whether an
arc is there by going back through the gadgets that made its two ends. Encoding reads a word once: a trie with
failure links (Aho-Corasick) names the tokens that end at each place, and the one with an arc from the state where
it starts is the last token of the encoding up to there; there is exactly one. Following these back gives the word's
tokens, and the labels of its arcs are the decoded text.

Null texts are empty; an empty text has no tokens. Very long words cost time in proportion to their length. Rows
that repeat are encoded once each, and other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from kerbside.llm.common import map_batches, texts_of

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
# Entries of a worker's caches; a full cache starts anew.
WORDS, ARCS = 500_000, 1_000_000
# Fixed value: the split pattern of the tokenizer file; LATIN is the same for characters below U+0250, in which the
# standard library's faster matcher can be used. Digits other than 0-9 are no decimals there, but numbers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN = r"'(?:[stmd]|re|ve|ll)|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\w\s]|[_\x1c-\x1f])+"
BEYOND_LATIN = re.compile("[^\x00-\u024f]")
# Stands for the end-of-word mark, so that it is one character of a label.
WORD_END = ""


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself if it is a visible Latin-1 character, else the next from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


class _Arcs(dict):
    """Arcs that have been looked up, by u * width + v."""

    def __init__(self, automaton: Automaton) -> None:
        self.automaton = automaton

    def __missing__(self, key: int) -> bool:
        if len(self) >= ARCS:
            self.clear()
        found = self[key] = self.automaton.arc(*divmod(key, self.automaton.width))
        return found


class Automaton:
    """The token automaton of a list of merges, with a table of the tokens that end at each place of a word."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str = "") -> None:
        def label(token: str) -> str:
            return token[:-len(suffix)] + WORD_END if suffix and token.endswith(suffix) else token

        self.end = WORD_END if suffix else ""
        self.rank = {(vocab[a], vocab[b]): k for k, (a, b) in enumerate(merges)}
        self.made = dict.fromkeys(vocab.values(), -1)
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        for (u, v), (a, b) in zip(self.rank, merges):
            m, k = vocab[a + b], self.rank[u, v]
            if self.made[m] >= 0 or self.made[u] >= k or self.made[v] >= k:
                raise ValueError(f"merge {k} makes a token twice, or uses one that a later merge makes")
            self.made[m], self.left[m], self.right[m] = k, u, v
        self.known = _Arcs(self)
        self.width = max(vocab.values()) + 1
        self.table = ahocorasick.Automaton()
        # A token is read somewhere only if its right part could follow its left one when it was made.
        read = {i for token, i in vocab.items() if self.made[i] < 0 and len(label(token).rstrip(WORD_END)) == 1}
        for m in sorted(self.left, key=self.made.__getitem__):
            if self.left[m] in read and self.right[m] in read and self._made_with(self.left[m], self.right[m]):
                read.add(m)
        for token, i in vocab.items():
            if i in read:
                self.table.add_word(label(token), (i, len(label(token))))
        self.table.make_automaton()

    def arc(self, u: int, v: int) -> bool:
        """Whether token v may follow token u in an encoding."""
        return (u, v) not in self.rank and self._made_with(u, v)

    def _made_with(self, u: int, v: int) -> bool:
        """Whether the arc was there once both tokens had been made."""
        rank, made, left, right = self.rank, self.made, self.left, self.right
        while (late := max(made[u], made[v])) >= 0:
            if u == v:
                u, v = right[u], left[v]
                gone = rank.get((u, v), late) < late
            elif made[u] == late:
                u = right[u]
                gone = rank.get((u, v), late) < late
            else:  # pairs are merged from the left: a u just before v's own u would have been taken first
                v = left[v]
                gone = rank.get((u, v), late + 1) <= late
            if gone:
                return False
        return True

    def encode(self, word: str) -> list[int]:
        """Tokens of a word given in byte letters."""
        text = word + self.end
        last: list[int | None] = [None] * (len(text) + 1)
        came = [0] * (len(text) + 1)
        known, width = self.known, self.width
        for place, (token, n) in self.table.iter(text):
            place += 1
            if last[place] is None:
                start = place - n
                if start:
                    before = last[start]
                    if before is None or not known[before * width + token]:
                        continue
                last[place], came[place] = token, start
        tokens, at = [], len(text)
        while at:
            if last[at] is None:
                raise ValueError(f"no encoding for {word!r}")
            tokens.append(last[at])
            at = came[at]
        return tokens[::-1]


class _Words(dict):
    """Decimal ids and labels of a word, each joined by spaces."""

    def __init__(self, automaton: Automaton, labels: dict[int, str]) -> None:
        self.automaton, self.labels, self.letters = automaton, labels, byte_letters()

    def __missing__(self, word: str) -> tuple[str, str]:
        if len(self) >= WORDS:
            self.clear()
        ids = self.automaton.encode("".join([self.letters[b] for b in word.encode()]))
        found = " ".join(map(str, ids)), " ".join([self.labels[i] for i in ids])
        if len(word) <= 64:
            self[word] = found
        return found


class WordCoder:
    """Encoder and decoder of a word-level tokenizer file: white space dropped, words encoded apart."""

    def __init__(self, name: str) -> None:
        path = public_tokenizers.path(name)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, library = spec["model"], Tokenizer.from_file(path)
        steps = [step["type"] for step in (spec["normalizer"] or {}).get("normalizers", [])]
        split, *rest = spec["pre_tokenizer"].get("pretokenizers", [{}])
        if (steps != ["NFC", "Replace", "Lowercase"] or split.get("behavior") != "Removed" or not split.get("invert")
                or [step["type"] for step in rest] != ["ByteLevel"] or spec["decoder"] or model["byte_fallback"]):
            raise ValueError(f"{name} is no tokenizer of lower-case words split by a pattern")
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.added = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.added_pattern = regex.compile("|".join(map(regex.escape, self.added)) or "(?!)")
        # Labels of all arcs; those of added tokens lead from any state to the first.
        self.labels = {i: token for token, i in {**model["vocab"], **self.added}.items()}
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.latin = re.compile(LATIN) if split["pattern"]["Regex"] == PATTERN else None
        self.normalize = library.normalizer.normalize_str
        automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"] or "")
        self.words = _Words(automaton, self.labels)

    def _plain(self, text: str) -> list[tuple[str, str]]:
        # Below U+0250 nothing composes, and case and classes of characters are the same for both libraries.
        if BEYOND_LATIN.search(text):
            found = self.pattern.findall(self.normalize(text))
        elif self.latin:
            found = self.latin.findall(text.lower())
        else:
            found = self.pattern.findall(text.lower())
        return [self.words[word] for word in found]

    def round_trip(self, text: str) -> tuple[str, str]:
        """Decimal ids of a text and the text they decode to, each joined by spaces."""
        found, at = [], 0
        for match in self.added_pattern.finditer(text) if "<" in text else ():
            found += [*self._plain(text[at:match.start()]), (str(self.added[match.group()]), match.group())]
            at = match.end()
        found += self._plain(text[at:])
        return " ".join([a for a, _ in found]), " ".join([b for _, b in found])


@lru_cache(maxsize=2)
def word_coder(name: str) -> WordCoder:
    return WordCoder(name)


def _hex(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def encode_documents(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", keep: bool = False) -> DataFrame:
    """Token counts of whole texts with digests of their ids and decoded texts; with `keep`, the ids and the decoded
    text themselves as well."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = word_coder(tokenizer)
        trips = [coder.round_trip(text) for text in texts_of(batch)]
        columns = [pa.array([a.count(" ") + 1 if a else 0 for a, _ in trips], pa.int64()),
                   pa.array([_hex(a) for a, _ in trips], pa.string()),
                   pa.array([_hex(b) for _, b in trips], pa.string())]
        if keep:
            columns += [pa.array([list(map(int, a.split())) for a, _ in trips], pa.list_(pa.int32())),
                        pa.array([b for _, b in trips], pa.string())]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names[:len(columns) + 1])
    return map_batches(docs.select("doc_id", "text"), work,
                       SCHEMA + (", ids array<int>, decoded string" if keep else ""))
