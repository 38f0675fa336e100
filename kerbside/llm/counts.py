"""Token counts of a unigram tokenizer, by a Viterbi search that only counts.

A text is normalized as its model does: each space becomes the word mark U+2581, one stands before the text unless it
begins with a space, and a new word begins at each mark. Within a word, an Aho-Corasick automaton names all pieces of
the vocabulary that end at each place, and the search keeps, for each place, the best sum of scores and the number
of pieces on the way to it. The rules are those of the tokenizers library's unigram model, sums being added from the
left in double precision:

- of equal sums, the path whose last piece is the longest one stays;
- where no piece of one character begins at a place, that character may be an unknown piece, with the lowest score of
  all less 10; of equal sums, a piece goes before it if it is longer;
- unknown characters that follow each other are one piece, or with byte fallback as many as they have UTF-8 bytes.

Words are counted once per worker and kept in a bounded cache; a long text without spaces costs time in proportion to
its length. Null texts are empty, and an empty text has no tokens. Repeated rows are counted once each. Other columns
are not read. An empty table gives no rows.
"""

from __future__ import annotations

from functools import lru_cache

import ahocorasick
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame

from kerbside.llm.common import map_batches, texts_of

MARK = "▁"
UNKNOWN_PENALTY = 10.0
WORDS = 400_000


class UnigramCounter:
    """Counts the pieces of words for a vocabulary of (piece, score)."""

    def __init__(self, vocab: list[tuple[str, float]], byte_fallback: bool) -> None:
        self.byte_fallback = byte_fallback and all(f"<0x{b:02X}>" in dict(vocab) for b in range(256))
        self.unknown = min((score for _, score in vocab), default=0.0) - UNKNOWN_PENALTY
        self.table = ahocorasick.Automaton()
        for piece, score in vocab:
            if piece:
                self.table.add_word(piece, (len(piece), score))
        self.table.make_automaton()
        self.words: dict[str, int] = {}

    def count_word(self, word: str) -> int:
        """Pieces of one word, marks included."""
        n = len(word)
        # Pieces by where they begin; paths that leave a place are tried in order of where they end.
        begins: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for place, (size, score) in self.table.iter(word) if len(self.table) else ():
            begins[place + 1 - size].append((size, score))
        best: list[float | None] = [0.0] + [None] * n
        count = [0] * (n + 1)
        open_run = [False] * (n + 1)  # whether the path ends with an unknown piece
        for at in range(n):
            here = best[at]
            if here is None:
                continue
            single = False
            for size, score in begins[at]:
                single = single or size == 1
                total, stop = here + score, at + size
                if best[stop] is None or total > best[stop]:
                    best[stop], count[stop], open_run[stop] = total, count[at] + 1, False
            if not single:
                total = here + self.unknown
                if best[at + 1] is None or total > best[at + 1]:
                    more = len(word[at].encode("utf-8", "surrogatepass")) if self.byte_fallback else not open_run[at]
                    best[at + 1], count[at + 1], open_run[at + 1] = total, count[at] + more, True
        return count[n]

    def count(self, text: str) -> int:
        marked = text.replace(" ", MARK)
        if marked and marked[0] != MARK:
            marked = MARK + marked
        known, total = self.words, 0
        for word in marked.split(MARK)[1:]:
            found = known.get(word)
            if found is None:
                found = self.count_word(MARK + word)
                if len(known) >= WORDS:
                    known.clear()
                if len(word) <= 64:
                    known[word] = found
            total += found
        return total


def model_vocab(name: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece model file, in order of id."""
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


@lru_cache(maxsize=2)
def model_counter(name: str) -> UnigramCounter:
    return UnigramCounter(model_vocab(name), byte_fallback=True)


def count_tokens(docs: DataFrame, model: str = "piece_bpe_32k.model") -> DataFrame:
    """(doc_id, n_chars, n_tokens) of every document. Scores are taken from the file as they stand."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter, texts = model_counter(model), texts_of(batch)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(map(len, texts), pa.int64()),
                                           pa.array(map(counter.count, texts), pa.int64())],
                                          ["doc_id", "n_chars", "n_tokens"])
    return map_batches(docs.select("doc_id", "text"), work, "doc_id long, n_chars long, n_tokens long")
