"""Language identification by rank-order profiles of character n-grams.

A profile lists the `PROFILE` most frequent n-grams (one to three characters of the lower-case text, every run of
other characters than letters being one space) of a language, over all its training documents. A document's own list
is compared with each profile: an n-gram counts the difference of its two places, or `PROFILE` where the profile
lacks it. The language with the least sum wins, of equal ones the first by name; score is 1 - sum / largest sum.

A text that is null or has no letter gets `und` and score 0. Ties of counts go to the smaller n-gram code. With no
training document every text gets `und`. Repeated rows are counted and predicted once each; other columns are not
read (`keep_known` returns them unchanged). Counting covers all training documents: tasks add up what they read, a
shuffle adds up the tasks. Only the profiles, at most LANGUAGES x PROFILE rows, come to the driver. Of more values of lang
than LANGUAGES, those with the most training documents have profiles, of equal ones the first by name.

`keep_known` also rejects texts that are in none of the languages. Each language has a bound: the score below which QUIET
of its training documents lie that are predicted as such, to a thousandth, times LEAST. So it follows from how like its own
profile a language's texts are, and a few odd documents do not move it. A language of which no training document is
predicted has bound 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import BATCH_ROWS, id_checksum, map_arrow, map_batches, texts_of

PROFILE = 400
LANGUAGES = 300
UNKNOWN = "und"
QUIET, LEAST, BINS = 0.01, 0.6, 1000
# Distinct n-grams of a language that a task holds before it passes its counts on.
HELD = 2_000_000
SPACE = 32


@lru_cache(maxsize=1)
def letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def grams(text: str) -> np.ndarray:
    """Codes of all n-grams of a text, none if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    is_letter = letters()[points]
    if not is_letter.any():
        return points[:0]
    line = np.concatenate([[SPACE], np.where(is_letter, points, SPACE), [SPACE]])
    blank = line == SPACE
    line = line[~(blank & np.r_[False, blank[:-1]])]
    pairs = (line[:-1] << 21) | line[1:]
    return np.concatenate([line[line != SPACE], pairs, (pairs[:-1] << 21) | line[2:]])


def count_grams(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) of documents with columns text and lang."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def rows(lang: str) -> pa.RecordBatch:
            codes, n = held.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(codes), pa.string()), pa.array(codes),
                                               pa.array(n)], ["lang", "gram", "n"])

        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                by_lang: dict[str, list[str]] = {}
                for lang, text in zip(part.column("lang").to_pylist(), texts_of(part)):
                    by_lang.setdefault(lang, []).append(text)
                for lang, texts in by_lang.items():
                    for few in iter(lambda i=iter(texts): list(islice(i, 100)), []):
                        codes, n = np.unique(np.concatenate([grams(text) for text in few]), return_counts=True)
                        if lang in held:
                            both = np.concatenate([held[lang][0], codes])
                            codes, place = np.unique(both, return_inverse=True)
                            n = np.bincount(place, np.concatenate([held[lang][1], n])).astype(np.int64)
                        held[lang] = codes, n
                        if len(codes) > HELD:
                            yield rows(lang)
        for lang in list(held):
            yield rows(lang)
    return (map_arrow(docs.select("lang", "text"), run, "lang string, gram long, n long")
            .groupBy("lang", "gram").agg(F.sum("n").alias("n")))


class Profiles:
    """Places of n-grams in the profiles of all languages."""

    def __init__(self, rows: list[tuple[str, int, int]]) -> None:
        self.names = sorted({lang for lang, _, _ in rows})
        column = {lang: k for k, lang in enumerate(self.names)}
        self.grams = np.unique(np.array([gram for _, gram, _ in rows], np.int64))
        self.places = np.full((len(self.grams) + 1, len(self.names)), PROFILE, np.int32)
        for lang, gram, place in rows:
            self.places[np.searchsorted(self.grams, gram), column[lang]] = place

    def predict(self, text: str) -> tuple[str, float]:
        codes, n = np.unique(grams(text), return_counts=True)
        if not len(codes) or not self.names:
            return UNKNOWN, 0.0
        own = codes[np.argsort(-n, kind="stable")[:PROFILE]]
        at = np.searchsorted(self.grams, own)
        at[self.grams[np.minimum(at, len(self.grams) - 1)] != own] = len(self.grams)
        places = self.places[at]
        apart = np.where(places < PROFILE, np.abs(places - np.arange(len(own))[:, None]), PROFILE).sum(0)
        best = int(apart.argmin())
        return self.names[best], 1.0 - float(apart[best]) / (PROFILE * len(own))


def learn(docs: DataFrame) -> Profiles:
    """Profiles of the languages in a frame with columns text and lang; rows with no language do not count."""
    labelled = docs.filter("lang is not null")
    most = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).select("lang")
    counts = count_grams(labelled.join(F.broadcast(most), "lang", "left_semi"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("place", place).filter(F.col("place") <= PROFILE).select("lang", "gram", "place")
    return Profiles([(lang, gram, k - 1) for lang, gram, k in top.limit(LANGUAGES * PROFILE).collect()])


def bounds(docs: DataFrame, profiles: Profiles) -> dict[str, float]:
    """The least score of each language that a text of it may have, from a frame of training documents."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [profiles.predict(text) for text in texts_of(batch)]
        right = [lang == own for (lang, _), own in zip(found, batch.column("lang").to_pylist())]
        return pa.RecordBatch.from_arrays(
            [pa.array([lang if ok else None for (lang, _), ok in zip(found, right)], pa.string()),
             pa.array([min(BINS - 1, int(score * BINS)) for _, score in found], pa.int32())], ["lang", "bin"])
    scored = map_batches(docs.filter("lang is not null").select("lang", "text"), work, "lang string, bin int")
    counts = scored.filter("lang is not null").groupBy("lang", "bin").agg(F.count("*").alias("n"))
    up_to = Window.partitionBy("lang").orderBy("bin")
    shares = counts.select("lang", "bin", (F.sum("n").over(up_to) / F.sum("n").over(Window.partitionBy("lang"))).alias("share"))
    rows = shares.filter(F.col("share") >= QUIET).groupBy("lang").agg(F.min("bin").alias("bin")).collect()
    return {lang: LEAST * low / BINS for lang, low in rows}


def held_out(fold: int = 1, folds: int = 3) -> Column:
    return F.coalesce(id_checksum() % folds == fold, F.lit(False))


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """(doc_id, lang_pred, score) of every document."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [profiles.predict(text) for text in texts_of(batch)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([a for a, _ in found], pa.string()),
                                           pa.array([b for _, b in found], pa.float64())],
                                          ["doc_id", "lang_pred", "score"])
    return map_batches(docs.select("doc_id", "text"), work, "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, profiles: Profiles, least: dict[str, float]) -> DataFrame:
    """The documents whose text is in a learned language: it has a letter, and its score reaches the language's bound."""
    def known(text: str) -> bool:
        lang, score = profiles.predict(text)
        return lang != UNKNOWN and score > 0 and score >= least.get(lang, 0.0)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        return batch.filter(pa.array([known(text) for text in texts_of(batch)], pa.bool_()))
    return map_batches(docs, work, docs.schema)
