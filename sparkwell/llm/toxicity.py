"""Toxicity: a Levenshtein automaton over a lexicon trie, weighed by the words around each hit.

The lexicon is learned: words that labelled toxic documents have far more often than
clean ones. Its trie and a Levenshtein automaton are walked together; the product is made
deterministic as it is met, so a word costs one look-up per character. Terms of up to three
letters must match exactly, longer ones may differ by one or two edits anywhere, the first letter
included. A word that clean documents use is no misspelling.

Each hit is judged in a window of words: quotation marks and reporting words speak for
quotation, second person and further hits for abuse. A document's counts by kind of hit enter a
logistic score, fitted towards stated prior weights.

Learning reads a bounded sample of labelled rows (``MAX_LABELLED``, by hash of the id); scoring reads
every whole text. Model size is bounded by ``MAX_TERMS`` and ``MAX_CLEAN``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwell.llm.common import small_side, stored
from sparkwell.llm.text import slices

MAX_LABELLED = 40_000
MAX_TERMS, MAX_CLEAN = 2_000, 50_000
#: A term is in so many toxic documents at least, and so much more likely there than in clean ones.
#: The evidence is a log-likelihood ratio; the fit weighs what chance still lets through.
MIN_TOXIC, MIN_ODDS, MIN_EVIDENCE = 3, 20.0, 13.0
WINDOW = 4
#: Words whose distance is kept, and entries of the machine's states, before they are built anew.
CACHED_WORDS, CACHED_ENTRIES = 400_000, 1_000_000
LONG_WORD = 64
THRESHOLD = 0.7
EDGES = " \t.,;:!?\"'()[]{}<>«»„“”‘’…-*_`"
QUOTES = re.compile(r"[\"«»„“”‘’`]|'(?=\s|$)|(?:^|(?<=\s))'")
#: Words of reporting, and of address, in the languages of the corpus.
REPORTING = set("said says wrote called quoted quote reported term word sagte schrieb nannte zitat wort dit écrit appelé mot dijo escribió llamó palabra cita".split())
ADDRESS = set("you your you're youre u du dich dein ihr euch tu toi ton vous votre tú eres ustedes vosotros".split())
#: Weights before learning: bias, exact, fuzzy, exact in quotation, fuzzy in quotation, addressed, hits in company.
PRIOR = np.array([-4.0, 6.0, 3.0, 1.0, 0.3, 1.0, 0.5])


def words_of(text: str) -> list[str]:
    return [w.strip(EDGES) for w in text.lower().split()]


def edits_allowed(term: str) -> int:
    return 0 if len(term) < 4 else 1 if len(term) < 9 else 2


class Automaton:
    """Lexicon trie and Levenshtein automaton as one machine; ``distance(word)`` is None if no term is near."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.allowed = [-1]  # of a term that ends here
        self.reach = [0]  # most edits allowed to any term below
        for term in terms:
            node, edits = 0, edits_allowed(term)
            self.reach[0] = max(self.reach[0], edits)
            for char in term:
                node = self.children[node].setdefault(char, len(self.children))
                if node == len(self.children):
                    self.children.append({})
                    self.allowed.append(-1)
                    self.reach.append(0)
                self.reach[node] = max(self.reach[node], edits)
            self.allowed[node] = edits
        #: lengths that a hit can have
        self.lengths = {len(t) + d for t in terms for d in range(-edits_allowed(t), edits_allowed(t) + 1)}
        self._reset()

    def _reset(self) -> None:
        self.number: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.ends: list[int | None] = []
        self.entries = 0
        self.start = self._state({0: 0})

    def _state(self, low: dict[int, int]) -> int:
        """The machine's state for the least edits by trie node; -1 when nothing is left."""
        queue = list(low)
        while queue:  # letters of a term that the word leaves out
            node = queue.pop()
            edits = low[node] + 1
            if edits <= self.reach[node]:
                for child in self.children[node].values():
                    if edits <= self.reach[child] and edits < low.get(child, 99):
                        low[child] = edits
                        queue.append(child)
        key = frozenset(low.items())
        if not key:
            return -1
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(key)
            self.entries += len(key)
            self.moves.append({})
            self.ends.append(min((e for n, e in key if e <= self.allowed[n]), default=None))
        return self.number[key]

    def _move(self, state: int, char: str) -> int:
        low: dict[int, int] = {}

        def add(node, edits):
            if edits <= self.reach[node] and edits < low.get(node, 99):
                low[node] = edits

        for node, edits in self.sets[state]:
            if (child := self.children[node].get(char)) is not None:
                add(child, edits)
            if edits < self.reach[node]:
                add(node, edits + 1)
                for child in self.children[node].values():
                    add(child, edits + 1)
        return self._state(low)

    def distance(self, word: str) -> int | None:
        if len(word) not in self.lengths:
            return None
        if self.entries > CACHED_ENTRIES:
            self._reset()
        state, moves = self.start, self.moves
        for char in word:
            to = moves[state].get(char)
            if to is None:
                to = moves[state][char] = self._move(state, char)
            if to < 0:
                return None
            state = to
        return self.ends[state]


@dataclass
class Model:
    terms: list[str]
    clean: list[str]
    weights: list[float]
    _machine: Automaton | None = field(default=None, repr=False)
    _known: dict[str, int | None] = field(default_factory=dict, repr=False)

    def distance(self, word: str) -> int | None:
        """Edits to the nearest term; None for a word that clean documents use."""
        if self._machine is None:
            self._machine = Automaton(self.terms)
            self._no = set(self.clean)
        if word in self._known:
            return self._known[word]
        if len(self._known) > CACHED_WORDS:
            self._known.clear()
        found = self._machine.distance(word) if word and len(word) <= LONG_WORD else None
        if found and word in self._no:
            found = None
        self._known[word] = found
        return found

    def hits(self, text: str) -> list[tuple[int, str, int, bool, bool, bool]]:
        """(word number, word, edits, quoted, addressed, in company) of each hit of a text."""
        words = words_of(text)
        get, distance = self._known.get, self.distance
        found = [(i, w, d) for i, w in enumerate(words) if (d := get(w, -1)) is not None and (d >= 0 or (d := distance(w)) is not None)]
        if not found:
            return []
        raw = text.split()
        at = {i for i, _, _ in found}
        out = []
        for i, word, edits in found:
            around = range(max(0, i - WINDOW), min(len(words), i + WINDOW + 1))
            before = any(QUOTES.search(raw[k]) for k in around if k <= i)
            after = any(QUOTES.search(raw[k]) for k in around if k >= i)
            quoted = (before and after) or any(words[k] in REPORTING for k in around)
            out.append((i, word, edits, quoted, any(words[k] in ADDRESS for k in around), any(k in at for k in around if k != i)))
        return out

    def features(self, text: str) -> list[float]:
        f = [1.0, 0, 0, 0, 0, 0, 0]
        for _, _, edits, quoted, addressed, company in self.hits(text):
            f[1 + (edits > 0) + 2 * quoted] += 1
            f[5] += addressed and not quoted
            f[6] += company and not quoted
        return [1.0, *(math.log1p(x) for x in f[1:])]

    def score(self, text: str) -> float:
        z = sum(w * x for w, x in zip(self.weights, self.features(text)))
        return 1 / (1 + math.exp(-max(min(z, 35), -35)))


def _fit(x: np.ndarray, y: np.ndarray, pull: float = 2.0) -> np.ndarray:
    """Logistic weights that stay near the prior where the rows say nothing; Newton steps."""
    w = PRIOR.copy()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        gradient = x.T @ (p - y) + pull * (w - PRIOR)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w)), gradient)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    w[1:] = np.maximum(w[1:], 0)
    return w


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, half, toxic, n): documents of each half and label that have a word."""
    for batch in batches:
        counts: dict[tuple, int] = {}
        for text, half, toxic in zip(*(c.to_pylist() for c in batch.columns)):
            for word in set(words_of(text or "")):
                if 2 <= len(word) <= LONG_WORD:
                    counts[word, half, toxic] = counts.get((word, half, toxic), 0) + 1
        columns = list(zip(*counts)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int32()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "half", "toxic", "n"],
        )


def learn(docs: DataFrame, labels: DataFrame, train: Column, max_labelled: int = MAX_LABELLED) -> Model:
    """A model of ``labels.toxic``, from texts of labelled rows for which ``train`` holds.

    Labels other than 0 and 1 do not count. Without any toxic row the lexicon is empty and
    every text has the score of no hit.
    """
    chosen = labels.filter(F.col("toxic").isin(0, 1) & train).select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropDuplicates(["doc_id"])
    chosen = stored(chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled), "labelled")
    half = (F.crc32(F.concat(F.lit("half"), F.col("doc_id").cast("string"))) % 2).cast("int")
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(small_side(chosen), "doc_id").select("text", half.alias("half"), "toxic")
    sample = stored(rows, "labelled-texts")
    sizes = {(r["half"], r["toxic"]): r["n"] for r in sample.groupBy("half", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    counted = sample.mapInArrow(_distinct_words, "word string, half int, toxic int, n bigint")
    pick = lambda half, toxic: F.coalesce(F.sum(F.when((F.col("half") == half) & (F.col("toxic") == toxic), F.col("n"))), F.lit(0))
    by_word = stored(counted.groupBy("word").agg(*[pick(h, t).alias(f"n{h}{t}") for h in (0, 1) for t in (0, 1)]), "label-words")
    n_toxic = max(sum(n for (_, t), n in sizes.items() if t), 1)
    n_clean = max(sum(n for (_, t), n in sizes.items() if not t), 1)
    toxic, clean = F.col("n01") + F.col("n11"), F.col("n00") + F.col("n10")
    odds = ((toxic + 0.5) / n_toxic) / ((clean + 0.5) / n_clean)
    share = n_toxic / (n_toxic + n_clean)
    surprise = lambda n, part: F.when(n > 0, n * F.log(n / ((toxic + clean) * part))).otherwise(F.lit(0.0))
    evidence = 2 * (surprise(toxic, share) + surprise(clean, 1 - share))
    lexicon = by_word.filter((toxic >= MIN_TOXIC) & (odds >= MIN_ODDS) & (evidence >= MIN_EVIDENCE)).orderBy(F.desc(toxic), F.desc(odds), "word").limit(MAX_TERMS)
    terms = [r["word"] for r in lexicon.select("word").collect()]

    # near words that clean documents use
    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Automaton(terms)
        for batch in slices(batches):
            keep = [bool(machine.distance(w)) for w in batch.column(0).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    used = by_word.filter(clean > 0).select("word", "n00", "n10").mapInArrow(near, "word string, n00 bigint, n10 bigint")
    used = used.orderBy(F.desc(F.col("n00") + F.col("n10")), "word").limit(MAX_CLEAN).collect()
    # the words of one half are clean for the fit on the other, as a new text's words are not known either
    first = Model(terms, [r["word"] for r in used if r["n00"]], PRIOR.tolist())

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = [first.features(t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), batch.column(1)], names=["x", "toxic"])

    fitted = sample.filter("half = 1").select("text", "toxic").mapInArrow(measured, "x array<double>, toxic int")
    grouped = fitted.groupBy("x", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()  # at most one row for each labelled row of the sample
    weights = PRIOR
    if grouped:
        x = np.repeat(np.array([r["x"] for r in grouped]), [r["n"] for r in grouped], axis=0)
        y = np.repeat(np.array([r["toxic"] for r in grouped], float), [r["n"] for r in grouped])
        weights = _fit(x, y)
    return Model(terms, [r["word"] for r in used], weights.tolist())


def score_toxicity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, predicted, hits) for each row of ``docs`` (doc_id, text).

    ``hits`` are (word number, word, edits, quoted, addressed, in company). Null counts as empty text, which
    has no hit and the score of none. Repeated rows give repeated results; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            hits = [model.hits(t) for t in texts]
            score = [model.score(t) if h else empty for t, h in zip(texts, hits)]
            rows = [[dict(zip(("word_no", "word", "edits", "quoted", "addressed", "company"), h)) for h in found] for found in hits]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), pa.array([int(s >= THRESHOLD) for s in score], pa.int32()), pa.array(rows, HITS)], names=["doc_id", "score", "predicted", "hits"])

    empty = model.score("")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    kind = "array<struct<word_no: int, word: string, edits: int, quoted: boolean, addressed: boolean, company: boolean>>"
    return rows.mapInArrow(run, f"doc_id bigint, score double, predicted int, hits {kind}")


HITS = pa.list_(
    pa.struct([("word_no", pa.int32()), ("word", pa.string()), ("edits", pa.int32()), ("quoted", pa.bool_()), ("addressed", pa.bool_()), ("company", pa.bool_())])
)
