"""Language ID by multilingual mixture inference.

A document is a mixture: each word is drawn from one of several languages. A word's likelihood
in a language comes from a byte trigram model (each byte given the two before it inside the word).
Expectation-maximisation finds the proportions of the languages; the set of languages
is the one of largest likelihood less a penalty for each more language. The prediction is the set's language of
largest proportion.

Learning reads about ``SAMPLE`` texts of each language, by hash of the id; inference reads every whole
text. The model has ``CELLS`` numbers for each language, so its size is bounded by the languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwell.llm.text import as_bytes, blocks, mix, slices

SAMPLE = 4_000
CELLS = 1 << 16
#: Partitions that count trigrams; each returns one table for each language.
COUNTERS = 8
SMOOTHING = 0.05
ROUNDS, SET_ROUNDS = 12, 5
#: Sets of up to so many languages are all tried; larger ones as long as the last language paid.
TRIED_SETS = 4
#: Log-likelihood that a further language must add, for each unit of log(words).
PENALTY = 1.5
UNKNOWN = "und"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LETTER = np.zeros(256, bool)
_LETTER[97:123] = _LETTER[128:] = True


class Letters:
    """Runs of letter bytes of several documents, each with the byte after it, and the cell of each trigram."""

    def __init__(self, docs: list[bytes]):
        raw = _LOWER[np.frombuffer(b"\n".join(docs) + b"\n", np.uint8)]
        ends = np.cumsum(np.fromiter(map(len, docs), np.int64, len(docs)) + 1)
        letter = _LETTER[raw]
        raw = np.where(letter, raw, 0).astype(np.int64)
        turn = np.diff(letter.astype(np.int8), prepend=0)
        start, stop = np.flatnonzero(turn == 1), np.flatnonzero(turn == -1)
        size = stop - start + 1  # with the byte that ends the word
        self.first = np.searchsorted(start, np.concatenate([[0], ends]))
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(docs)), self.count)
        self.head = np.cumsum(size) - size
        place = np.arange(size.sum()) - np.repeat(self.head, size)
        at = np.repeat(start, size) + place
        one = np.where(place > 0, raw[at - 1], 0)
        two = np.where(place > 1, raw[at - 2], 0)
        pair = (two << 8) | one
        self.pair = (mix(pair.astype(np.uint64)) >> np.uint64(48)).astype(np.int64)
        self.cell = (mix(((pair << 8) | raw[at]).astype(np.uint64) + np.uint64(1 << 32)) >> np.uint64(48)).astype(np.int64)


@dataclass
class Model:
    languages: list[str]
    log_p: np.ndarray  # CELLS x languages


def _counted(languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, pairs = {}, {}
        for batch in slices(batches):
            docs, langs = as_bytes(batch.column(1)), batch.column(0).to_pylist()
            for begin, stop in blocks(docs):
                for lang in set(langs[begin:stop]):
                    letters = Letters([d for d, x in zip(docs[begin:stop], langs[begin:stop]) if x == lang])
                    cells[lang] = cells.get(lang, 0) + np.bincount(letters.cell, minlength=CELLS)
                    pairs[lang] = pairs.get(lang, 0) + np.bincount(letters.pair, minlength=CELLS)
        for lang in cells:
            blobs = [pa.array([x[lang].astype("<u4").tobytes()]) for x in (cells, pairs)]
            yield pa.RecordBatch.from_arrays([pa.array([lang]), *blobs], names=["lang", "cells", "pairs"])

    return run


def learn(docs: DataFrame, train: Column, sample: int = SAMPLE) -> Model:
    """A model of the languages of the ``train`` rows; rows of null ``lang`` or ``text`` do not count."""
    rows = docs.filter(train & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.col("lang").cast("string"), F.col("text").cast("string"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((CELLS, 0), np.float32))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))
    limits = F.element_at(F.create_map(*[F.lit(x) for lang in languages for x in (lang, int(min(1.0, sample / sizes[lang]) * (1 << 20)))]), F.col("lang"))
    chosen = rows.filter(part < limits).select("lang", "text").repartition(COUNTERS)
    tables = chosen.mapInArrow(_counted(languages), "lang string, cells binary, pairs binary")
    cells, pairs = np.zeros((CELLS, len(languages))), np.zeros((CELLS, len(languages)))
    for r in tables.toLocalIterator():  # COUNTERS x languages rows of bounded size
        cells[:, languages.index(r["lang"])] += np.frombuffer(r["cells"], "<u4")
        pairs[:, languages.index(r["lang"])] += np.frombuffer(r["pairs"], "<u4")
    # a cell does not know its pair, so the pair's logarithm is taken off where words are scored: both tables are kept
    log_p = np.concatenate([np.log(cells + SMOOTHING), np.log(pairs + SMOOTHING * 40)], axis=1).astype(np.float32)
    return Model(languages, log_p)


def _estimate(share: np.ndarray, like: np.ndarray, letters: Letters, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions by document after some rounds, and the log-likelihood of each document relative to its words' best."""
    busy = np.flatnonzero(letters.count)
    heads = letters.first[:-1][busy]
    for _ in range(rounds):
        part = share[letters.doc] * like
        part /= part.sum(axis=1, keepdims=True)
        share = share.copy()
        share[busy] = np.add.reduceat(part, heads, axis=0) / letters.count[busy, None]
    total = np.zeros(len(share))
    total[busy] = np.add.reduceat(np.log((share[letters.doc] * like).sum(axis=1)), heads)
    return share, total


def infer(docs: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(proportions of the chosen set, words, confidence of the first language) by document."""
    letters, k = Letters(docs), len(model.languages)
    if not k or not len(letters.doc):
        return np.zeros((len(docs), k)), letters.count, np.zeros(len(docs))
    log = np.add.reduceat(model.log_p[letters.cell, :k] - model.log_p[letters.pair, k:], letters.head, axis=0).astype(np.float64)
    like = np.maximum(np.exp(log - log.max(axis=1, keepdims=True)), 1e-9)
    share, _ = _estimate(np.full((len(docs), k), 1 / k), like, letters, ROUNDS)
    rank = np.argsort(np.argsort(-share, axis=1, kind="stable"), axis=1, kind="stable")
    best, value = np.zeros_like(share), np.full(len(docs), -np.inf)
    going = np.ones(len(docs), bool)
    for size in range(1, k + 1):
        if not going.any():
            break
        held = np.where(rank < size, np.maximum(share, 1e-6), 0)
        found, total = _estimate(held / held.sum(axis=1, keepdims=True), like, letters, SET_ROUNDS if size > 1 else 0)
        total = total - PENALTY * (size - 1) * np.log(np.maximum(letters.count, 2))
        better = going & (total > value + 1e-9)
        best[better], value[better] = found[better], total[better]
        if size >= TRIED_SETS:
            going = better
    sums = np.zeros((len(docs), k))
    busy = np.flatnonzero(letters.count)
    sums[busy] = np.add.reduceat(np.log(like), letters.first[:-1][busy], axis=0)
    first = best.argmax(axis=1)
    lead = sums[np.arange(len(docs)), first].copy()
    sums[np.arange(len(docs)), first] = -np.inf
    gap = lead - sums.max(axis=1) if k > 1 else np.full(len(docs), 30.0)
    sure = 1 / (1 + np.exp(-np.clip(gap, -30, 30)))
    return best, letters.count, np.where(best.max(axis=1) < 1, best.max(axis=1), sure)


def _predict(texts: list[str | None], model: Model) -> list[tuple[str, float, list[tuple[str, float]]]]:
    """(language, score, proportions) of each text."""
    docs, out = [(t or "").encode() for t in texts], []
    for begin, stop in blocks(docs):
        share, words, sure = infer(docs[begin:stop], model)
        for i in range(stop - begin):
            # bytes of other characters than letters may look like letters; the text itself decides
            if not words[i] or not model.languages or not any(map(str.isalpha, texts[begin + i])):
                out.append((UNKNOWN, 0.0, []))
                continue
            order = np.argsort(-share[i], kind="stable")
            out.append((model.languages[order[0]], float(sure[i]), [(model.languages[j], float(share[i, j])) for j in order if share[i, j] > 0.005]))
    return out


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, mixture) for each row of ``docs`` (doc_id, text).

    ``mixture`` maps each language of the chosen set to its proportion. Null texts and texts without a
    letter are ``und`` with score 0. Ties go to the language first in order of name. Repeated rows give
    repeated results; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = _predict(batch.column(1).to_pylist(), model)
            lang, score, sets = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(sets, pa.map_(pa.string(), pa.float64()))],
                names=["doc_id", "lang_pred", "score", "mixture"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, lang_pred string, score double, mixture map<string,double>")


def without_language_removed(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` in which some language is found, with their columns."""

    @F.arrow_udf("boolean")
    def found(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for text in texts:
            parts = slices([pa.RecordBatch.from_arrays([text], names=["text"])])
            yield pa.array([lang != UNKNOWN for part in parts for lang, _, _ in _predict(part.column(0).to_pylist(), model)], pa.bool_())

    # only the text goes to Python, and only the verdict comes back
    return docs.filter(found(F.col("text").cast("string")))
