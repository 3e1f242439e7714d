"""Spelling variant grouping by pivotal grams.

Words are counted over all documents. Two words are near if one inserted, deleted or replaced
code point makes one into the other. Bigrams are ranked by how many places of the
vocabulary hold them. A word's *prefix* is its three places of rarest bigrams, with further places of the third
one's bigram; its two *pivots* are the disjoint ones of those three places whose bigrams are rarest together, found by
dynamic programming.

One edit spoils at most one of two disjoint bigrams. Of two near words, the one whose
third rarest bigram ranks first therefore has a pivot that is left whole, and that ranks early enough to be in the
other's prefix. So pivots are joined to prefixes, and nothing else is compared. Position limits: all before the
edit has the same position in both words, and all after it is shifted as the lengths differ, by one at
most. So with the pivot the words share a head or a tail up to it, and what lies beyond the other pivot, unless the edit lies there.
The shared head and tail are the join key, which makes the list of a frequent bigram many short ones. A
pair found is verified by edit distance.

A word's form is its near word of largest count, if that is at least twice its own; roots follow forms by
doubling steps, since counts at least double along a chain.
"""

from __future__ import annotations

import heapq
import itertools
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkwell.llm.common import stored
from sparkwell.llm.text import slices

#: One run in DROP_EVERY loses a letter; words have this length and count at least; forms have this multiple.
DROP_EVERY = 97
LEAST_LENGTH, LEAST_COUNT, FORM_MULTIPLE = 5, 3, 2

PIECE = 1 << 20
#: Distinct words that a task holds before it hands its counts on.
HELD = 200_000
PREFIX, TIES = 3, 5
#: Code points beyond the other pivot that a key holds at most; of longer ones the outermost.
REACH = 16
SHORT = 64

_RUN = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LEAST_LENGTH)  # shorter runs make no word
_GAP = re.compile(rb"[^a-z\xc0-\xff]")


def _pieces(text: bytes) -> Iterator[bytes]:
    """Parts of about PIECE bytes, cut where no letter stands, so no run is cut."""
    begin = 0
    while begin < len(text):
        stop = begin + PIECE
        if stop < len(text):
            gap = _GAP.search(text, stop)
            stop = gap.start() if gap else len(text)
        yield text[begin:stop]
        begin = stop


def _count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of each document, some of them short of a letter, counted per task.

    Letters up to U+00FF are one byte of Latin-1 each and all others become ``?``, so bytes are code points here.
    """
    total: Counter[bytes] = Counter()

    def handed_on() -> pa.RecordBatch:
        words = pa.array([w.decode("latin-1") for w in total], pa.string())
        rows = pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])
        total.clear()
        return rows

    for batch in slices(batches):
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not text:
                continue
            begun = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
            for piece in _pieces(text.encode("latin-1", "replace").lower()):
                for run, n in Counter(_RUN.findall(piece)).items():
                    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), begun)
                    if h % DROP_EVERY == 0:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < LEAST_LENGTH:
                            continue
                    total[run] += n
                if len(total) > HELD:
                    yield handed_on()
    if total:
        yield handed_on()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(word, n): the words of ``docs`` (doc_id, text) and how often each occurs.

    bytes.lower() on Latin-1 text changes A-Z only. Null texts have no words; a null doc_id counts as empty
    text in the checksum; repeated rows count each time.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(_count_runs, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Counter[str] = Counter()
    for batch in batches:
        for word in batch.column(0).to_pylist():
            total.update(map("".join, zip(word, word[1:])))
    yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["gram", "places"])


def prefix_and_pivots(word: str, rank: dict[str, tuple[int, int]]) -> tuple[list[int], list[int]]:
    """Places of the prefix of a word, and of its two pivots. ``rank`` has (rank, number of places) of each bigram.

    Of a bigram that recurs, an edit shifts which occurrence is which by TIES - PREFIX at most, so that many more are kept.
    """
    known = [rank[word[i : i + 2]] for i in range(len(word) - 1)]
    rarest = heapq.nsmallest(PREFIX, range(len(known)), key=lambda i: (known[i][0], i))
    last = known[rarest[-1]][0]
    equal = (i for i, (r, _) in enumerate(known) if r == last)
    prefix = sorted([i for i in rarest if known[i][0] < last] + list(itertools.islice(equal, TIES)))
    # cheapest: the least (places, place) up to two places before; pair: the least sum with a place that is disjoint from it
    cheapest = pair = None
    waiting = 0
    rarest.sort()
    for at in rarest:
        while rarest[waiting] <= at - 2:
            one = (known[rarest[waiting]][1], rarest[waiting])
            cheapest = one if cheapest is None else min(cheapest, one)
            waiting += 1
        if cheapest is not None:
            both = (cheapest[0] + known[at][1], cheapest[1], at)
            pair = both if pair is None else min(pair, both)
    return prefix, [pair[1], pair[2]]


def _placed(rank: dict[str, tuple[int, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            found = [prefix_and_pivots(w, rank) for w in words]
            prefixes, pivots = zip(*found) if found else ((), ())
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(prefixes, ints), pa.array(pivots, ints)], names=["word", "n", "prefix", "pivots"])

    return run


def _keys(heads_and_tails: list[tuple[str, str]]) -> Column:
    """One hash of each (head, tail); two that clash by chance only add a pair, which the verification drops."""
    return F.explode(F.array(*(F.xxhash64(F.expr(head), F.expr(tail)) for head, tail in heads_and_tails)))


def _probes(words: DataFrame) -> DataFrame:
    """What a near word shares with a word, by where the edit is: after both pivots, before both, or after one and before the end of the other."""
    pivots = words.select("word", "n", "size", F.col("pivots")[0].alias("one"), F.col("pivots")[1].alias("two"))
    after = ("substring(word, 1, two + 2)", "''")
    before = ("''", "substring(word, one + 1)")
    spoils_two = ("substring(word, 1, one + 2)", f"right(word, least({REACH}, size - two - 2))")
    spoils_one = (f"substring(word, 1, least({REACH}, one))", "substring(word, two + 1)")
    return pivots.select(_keys([after, before, spoils_two, spoils_one]).alias("key"), "word", "n", "size")


def _entries(words: DataFrame) -> DataFrame:
    """Each place of the prefix, its bigram ending a head that goes with every tail, and starting a tail that goes with every head."""
    at = words.select("word", "n", "size", F.explode("prefix").alias("at"))
    far = lambda most: F.explode(F.sequence(F.lit(0), F.least(F.lit(REACH), most)))
    ends = at.withColumn("far", far(F.col("size") - F.col("at") - 2)).select(_keys([("substring(word, 1, at + 2)", "right(word, far)")]).alias("key"), "word", "n", "size")
    starts = at.withColumn("far", far(F.col("at"))).select(_keys([("substring(word, 1, far)", "substring(word, at + 1)")]).alias("key"), "word", "n", "size")
    return ends.unionAll(starts)


def _one_edit(x: str, y: str) -> Column:
    """Whether one edit tells two words of sizes at most one apart from each other.

    The edit distance of Spark takes the square of the length, so beyond SHORT the common head is found in
    steps of halved size, and what follows one code point later must be equal.
    """
    steps = ", ".join(f"{1 << k}" for k in range(30, -1, -1))
    head = f"aggregate(array({steps}), 0, (n, k) -> if(substring({x}.word, n + 1, k) = substring({y}.word, n + 1, k), n + k, n))"
    rest = f"(n -> substring({x}.word, n + if({x}.size >= {y}.size, 2, 1)) = substring({y}.word, n + if({y}.size >= {x}.size, 2, 1)))"
    by_head = F.expr(f"{x}.word <> {y}.word AND element_at(transform(array({head}), {rest[1:-1]}), 1)")
    return F.when(F.greatest(f"{x}.size", f"{y}.size") <= SHORT, F.levenshtein(f"{x}.word", f"{y}.word", 1) == 1).otherwise(by_head)


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, near_n), in both directions, of the words (word, n) that one edit tells apart."""
    # letters are a-z and U+00C0 to U+00FF, so there are at most 90 * 90 bigrams
    grams = words.select("word").mapInArrow(_count_grams, "gram string, places bigint").groupBy("gram").agg(F.sum("places").alias("places"))
    by_rarity = sorted((r["places"], r["gram"]) for r in grams.collect())
    rank = {gram: (i, places) for i, (places, gram) in enumerate(by_rarity)}
    placed = words.mapInArrow(_placed(rank), "word string, n bigint, prefix array<int>, pivots array<int>").withColumn("size", F.length("word"))
    placed = stored(placed, "spelling-places")
    x, y = _probes(placed).alias("x"), _entries(placed).alias("y")
    met = x.join(y, (F.col("x.key") == F.col("y.key")) & (F.abs(F.col("x.size") - F.col("y.size")) <= 1))
    met = met.filter(_one_edit("x", "y"))
    one = F.struct(F.col("x.word").alias("word"), F.col("y.word").alias("near"), F.col("y.n").alias("near_n"))
    two = F.struct(F.col("y.word").alias("word"), F.col("x.word").alias("near"), F.col("x.n").alias("near_n"))
    return met.select(F.explode(F.array(one, two)).alias("pair")).select("pair.*").distinct()


def _least_of_largest(n: Column, word: Column) -> Column:
    """The word of largest n; ties go to the smallest in code-point order."""
    return F.min(F.struct((-n).alias("n"), word.alias("word")))


def variant_groups(docs: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each word of ``docs`` (doc_id, text).

    Texts that are null or empty have no words; a table without words gives an empty result; other columns
    are ignored. Very long runs are words like others.
    """
    words = stored(vocabulary(docs), "spelling-words")
    best = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), _least_of_largest(F.col("near_n"), F.col("near")).alias("top"))
    known = words.join(best, "word", "left")
    has_form = -F.col("top.n") >= FORM_MULTIPLE * F.col("n")
    known = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(has_form, F.col("top.word")).alias("form"), F.when(has_form, -F.col("top.n")).alias("form_n"),
    )
    known = stored(known, "spelling-forms")
    # from word to the farthest word known so far; each round doubles the steps
    steps = known.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = stored(steps.join(further, "root", "left"), "spelling-roots")
        steps = joined.select("word", F.coalesce("next", "root").alias("root"))
        if joined.filter("next IS NOT NULL").isEmpty():
            break
    return known.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))
