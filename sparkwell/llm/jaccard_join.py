"""N-gram Jaccard join by set relations: equal sets, block-skipped lists, derived answers.

A document is the set of its distinct 5-word shingles (64-bit hashes). The join is exact:

* *Equal sets* share one answer: only distinct sets take part.
* *Index.* Any fixed order of the shingles admits the prefix filter: two sets of
  Jaccard j or more share one of the first n - ceil(j n) + 1 shingles of each. The
  order here is by hash, but shingles seen often in some part of the input
  come last (a bounded list, which affects speed only), so lists stay short
  although passages repeat. A list holds (set, size, position); it is split into
  blocks by size band, and a join of blocks skips those whose sizes or positions
  rule out the overlap.
* *Derived answers.* Per block the smallest set key leads. A set is first compared
  with the leader it meets most; if they link, the set joins the leader's group at
  a known distance. From then on groups are compared through their leaders. Jaccard
  distance is a metric, so a distance of two leaders beyond the bound plus both
  members' distances settles all pairs of the two groups without comparing them, and
  pairs already connected need no comparison at all. Only what remains is compared
  member by member. A parity bitmap of 256 bits per set bounds the
  symmetric difference from below and drops most pairs before any set is read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkwell.llm.common import small_side, stored
from sparkwell.llm.text import Words, as_bytes, blocks, mix, slices
from sparkwell.operators.graph import components

#: Similarity as a fraction, so that the limit is exact: 4 / 5.
NUM, DEN = 4, 5
#: Shingles met this often in one block of sets, and in all blocks together, may be ordered last.
OFTEN_IN_BLOCK, OFTEN = 4, 32
#: At most so many shingles are ordered last: bounds the broadcast to 1 MB.
MAX_LAST = 1 << 17
COUNT_BLOCK = 1 << 20


def _sets(docs: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per block of documents: first document, sorted distinct shingles, where each set ends, and set keys."""
    for begin, end in blocks(docs):
        hashes, doc = Words(docs[begin:end]).shingles()
        order = np.lexsort((hashes, doc))
        hashes, doc = hashes[order], doc[order]
        new = np.ones(len(hashes), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
        hashes, doc = hashes[new], doc[new]
        cut = np.searchsorted(doc, np.arange(end - begin + 1))
        total = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix(hashes + np.uint64(0x5851F42D4C957F2D)), out=total[1:])
        yield begin, hashes, cut, mix(total[cut[1:]] - total[cut[:-1]] + cut[1:].astype(np.uint64) - cut[:-1].astype(np.uint64))


BITS = ("b0", "b1", "b2", "b3")


def _bitmaps(hashes: np.ndarray, n: np.ndarray) -> np.ndarray:
    """256 bits for each set, as four integers: bit i is the parity of the shingles whose low byte is i."""
    cell = np.repeat(np.arange(len(n)), n) * 256 + (hashes & np.uint64(255)).astype(np.int64)
    return np.packbits((np.bincount(cell, minlength=256 * len(n)) & 1).astype(np.uint8)).view(np.int64).reshape(-1, 4)


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as kind 0 (id, hash of the text, set size, set key, parity bitmap); shingles frequent in a block of distinct sets, with their count, as kind 1."""
    pool: list[np.ndarray] = []
    held, seen = 0, set()

    def frequent():
        values, counts = np.unique(np.concatenate(pool), return_counts=True)
        often = counts >= OFTEN_IN_BLOCK
        zeros = np.zeros(often.sum(), np.int64)
        return row(1, zeros, zeros, counts[often], values[often], np.zeros((often.sum(), 4), np.int64))

    def row(kind, ids, texts, n, key, bits):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(key), kind, np.int8)), pa.array(ids, pa.int64()), pa.array(texts, pa.int64()), pa.array(n.astype(np.int64)), pa.array(key.view(np.int64))]
            + [pa.array(bits[:, i].copy()) for i in range(4)],
            names=["kind", "id", "text_hash", "n", "key", *BITS],
        )

    for batch in slices(batches):
        docs, ids, texts = as_bytes(batch.column(1)), batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for begin, hashes, cut, keys in _sets(docs):
            here = slice(begin, begin + len(keys))
            yield row(0, ids[here], texts[here], np.diff(cut), keys, _bitmaps(hashes, np.diff(cut)))
            for i, key in enumerate(keys.tolist()):
                if key not in seen:
                    seen.add(key)
                    pool.append(hashes[cut[i] : cut[i + 1]])
                    held += cut[i + 1] - cut[i]
            if held >= COUNT_BLOCK:
                yield frequent()
                pool, held, seen = [], 0, set()
    if pool:
        yield frequent()


def _prefixes(last: np.ndarray):
    """(token, set_key, n, pos, often) of the prefix of each set, once for equal sets of a partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in slices(batches):
            for _, hashes, cut, keys in _sets(as_bytes(batch.column(0))):
                n = np.diff(cut)
                doc = np.repeat(np.arange(len(n)), n)
                fresh = np.zeros(len(n), bool)
                for i, key in enumerate(keys.tolist()):
                    if key not in seen:
                        seen.add(key)
                        fresh[i] = True
                often = np.zeros(len(hashes), bool)
                if len(last):
                    often = last[np.minimum(np.searchsorted(last, hashes), len(last) - 1)] == hashes
                order = np.lexsort((hashes, often, doc))
                pos = np.arange(len(hashes)) - cut[doc]
                size = n[doc]
                keep = (pos < size - -(-NUM * size // DEN) + 1) & fresh[doc]
                picked = order[keep]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (hashes[picked].view(np.int64), keys[doc[keep]].view(np.int64), size[keep].astype(np.int32), pos[keep].astype(np.int32), often[picked])],
                    names=["token", "set_key", "n", "pos", "often"],
                )

    return run


def _whole_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(set_key, tokens) of the wanted sets."""
    for batch in slices(batches):
        wanted = np.array(batch.column(0).to_pylist(), np.int64)
        for begin, hashes, cut, keys in _sets(as_bytes(batch.column(1))):
            signed, view = keys.view(np.int64), hashes.view(np.int64)
            same = np.flatnonzero(signed == wanted[begin : begin + len(keys)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed[same]), pa.array([view[cut[i] : cut[i + 1]] for i in same], pa.list_(pa.int64()))], names=["set_key", "tokens"]
            )


def _least_distance(a: str, b: str) -> Column:
    """A lower bound of the Jaccard distance from sizes and parity bitmaps, as a double."""
    n = F.col(f"{a}.n") + F.col(f"{b}.n")
    apart = sum((F.bit_count(F.col(f"{a}.{x}").bitwiseXOR(F.col(f"{b}.{x}"))) for x in BITS), F.lit(0))
    apart = F.greatest(apart, F.abs(F.col(f"{a}.n") - F.col(f"{b}.n")))
    return 2 * apart / (n + apart)


#: Distances are ratios of integers below 2**31, so this margin never drops a true link.
LIMIT = 1 - NUM / DEN + 1e-9


class _Join:
    def __init__(self, docs: DataFrame):
        self.spark = docs.sparkSession
        #: a row is found again by its id and the hash of its text; rows that share both have one set
        self.docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), text_hash().alias("text_hash"))
        summary = self.docs.mapInArrow(_summaries, "kind tinyint, id bigint, text_hash bigint, n bigint, key bigint, b0 bigint, b1 bigint, b2 bigint, b3 bigint")
        summary = stored(summary, "sets")
        self.members = summary.filter("kind = 0").select(F.col("id").alias("doc_id"), "text_hash", F.col("n").alias("n_shingles"), F.col("key").alias("set_key"))
        self.bits = summary.filter("kind = 0 AND n > 0").select(F.col("key").alias("set_key"), F.col("n").cast("int").alias("n"), *BITS)
        #: one row for each distinct set: its first row, by id (null ids last) and hash of the text, and how many have it
        first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash"))
        self.classes = stored(self.members.filter("n_shingles > 0").groupBy("set_key").agg(first.alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
        often = summary.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= OFTEN)
        last = often.orderBy(F.desc("n"), "key").limit(MAX_LAST).select("key").toPandas()["key"].to_numpy(np.int64)
        self.last = np.sort(last.view(np.uint64))

    def index(self) -> DataFrame:
        """The lists of at least two distinct sets: (token, set_key, n, pos, band)."""
        rows = self.docs.select("text").mapInArrow(_prefixes(self.last), "token bigint, set_key bigint, n int, pos int, often boolean")
        # one exchange: a rare token goes to one task with its whole list; a frequent one, in company for sure, is spread
        part = F.when(F.col("often"), F.xxhash64("token", "set_key")).otherwise(F.col("token"))
        dealt = rows.withColumn("part", part).repartition("part").dropDuplicates(["part", "token", "set_key"])
        span = Window.partitionBy("part")
        dealt = dealt.withColumn("lo", F.min("set_key").over(span)).withColumn("hi", F.max("set_key").over(span))
        lists = dealt.filter("often OR lo < hi").select("token", "set_key", "n", "pos")
        band = F.floor(F.log(F.col("n").cast("double")) / math.log(DEN / NUM)).cast("int")
        return stored(lists.withColumn("band", band), "index")

    def tokens(self, keys: DataFrame, label: str) -> DataFrame:
        """(set_key, tokens) of some sets, read again from the text of one document of each."""
        wanted = self.classes.join(keys, "set_key").select("set_key", F.col("rep.doc_id").alias("id"), F.col("rep.text_hash").alias("hash"))
        wanted = small_side(stored(wanted, f"{label}-wanted"))
        texts = self.docs.join(wanted, (F.col("text_hash") == F.col("hash")) & F.col("doc_id").eqNullSafe(F.col("id"))).select("set_key", "text")
        found = texts.mapInArrow(_whole_sets, "set_key bigint, tokens array<bigint>")
        return stored(found.groupBy("set_key").agg(F.first("tokens").alias("tokens")), f"{label}-tokens")

    def compare(self, pairs: DataFrame, label: str) -> DataFrame:
        """Pairs (a, b, ...) with their exact Jaccard distance and whether they link."""
        pairs = stored(pairs, f"{label}-pairs")
        keys = pairs.select(F.col("a").alias("set_key")).union(pairs.select(F.col("b").alias("set_key"))).distinct()
        sets = self.tokens(keys, label)
        left, right = (sets.select(F.col("set_key").alias(x), F.col("tokens").alias(f"t{x}")) for x in "ab")
        both = F.size(F.array_intersect("ta", "tb"))
        either = F.size("ta") + F.size("tb") - F.col("both")
        return stored(
            pairs.join(left, "a").join(right, "b").withColumn("both", both).withColumn("either", either)
            .select(*pairs.columns, (1 - F.col("both") / F.col("either")).alias("distance"), (DEN * F.col("both") >= NUM * F.col("either")).alias("link")),
            f"{label}-compared",
        )

    def edges(self) -> DataFrame:
        """Links of distinct sets, enough to connect every pair that a chain of links connects."""
        index = self.index()
        listed = index.select("set_key").distinct()
        bits = stored(self.bits.distinct().join(listed, "set_key"), "bitmaps")

        # each set against the block leader that it meets most
        heads = index.groupBy("token", "band").agg(F.min("set_key").alias("b"))
        met = index.join(heads, ["token", "band"]).filter("set_key <> b").groupBy(F.col("set_key").alias("a"), "b").agg(F.count(F.lit(1)).alias("times"))
        near = met.alias("m").join(bits.alias("x"), F.col("m.a") == F.col("x.set_key")).join(bits.alias("y"), F.col("m.b") == F.col("y.set_key"))
        # a leader met in few lists is left to the comparison of groups
        near = near.filter((F.col("m.times") * 20 >= F.col("x.n")) & (_least_distance("x", "y") <= LIMIT)).select("m.a", "m.b", "m.times")
        best = near.groupBy("a").agg(F.max(F.struct("times", F.col("b"))).alias("top")).select("a", F.col("top.b").alias("b"))
        led = self.compare(best, "leader").filter("link")

        # groups against groups, through their leaders
        member = stored(led.select(F.col("a").alias("set_key"), F.col("b").alias("lead"), "distance"), "members")
        grouped = index.join(small_side(member), "set_key", "left")
        grouped = grouped.withColumn("lead", F.coalesce("lead", "set_key")).withColumn("distance", F.coalesce("distance", F.lit(0.0)))
        of_set = grouped.groupBy("set_key", "lead", "distance", "n").agg(F.count(F.lit(1)).alias("lists"))
        of_set = stored(of_set, "grouped")
        extent = of_set.groupBy("lead").agg(F.max("distance").alias("width"), F.min("n").alias("lo"), F.max("n").alias("hi"))
        leads = stored(extent.join(bits, F.col("set_key") == F.col("lead")).drop("set_key"), "leads")
        rows = grouped.groupBy("token").agg(F.min("lead").alias("first"), F.max("lead").alias("last")).filter("first < last").select("token")
        side = grouped.join(rows, "token", "left_semi").select("token", "band", "lead").distinct()
        side = stored(side.join(small_side(leads), "lead"), "blocks")
        # two sizes that may link lie in one band or in neighbouring ones
        other = side.withColumn("step", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("band", F.col("band") + F.col("step"))
        x, y = side.alias("x"), other.alias("y")
        sizes = (DEN * F.col("x.hi") >= NUM * F.col("y.lo")) & (DEN * F.col("y.hi") >= NUM * F.col("x.lo"))
        ordered = F.when(F.col("y.step") == 0, F.col("x.lead") < F.col("y.lead")).otherwise(F.col("x.lead") != F.col("y.lead"))
        slack = F.col("x.width") + F.col("y.width")
        far = _least_distance("x", "y") <= LIMIT + slack
        meet = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.band") == F.col("y.band")) & ordered & sizes & far)
        # shingles after the shorter prefix add at most what stands there, so the prefixes must share the rest
        least = (NUM * (F.col("x.lo") + F.col("y.lo")) / (NUM + DEN)) - NUM * F.greatest("x.hi", "y.hi") / DEN
        met = meet.select(F.least("x.lead", "y.lead").alias("a"), F.greatest("x.lead", "y.lead").alias("b"), slack.alias("slack"), least.alias("least"))
        pairs = met.groupBy("a", "b", "slack", "least").agg(F.count(F.lit(1)).alias("shared")).filter(F.col("shared") >= F.col("least") - 1)
        pairs = pairs.select("a", "b", "slack")
        groups = self.compare(pairs, "group")
        links = led.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionByName(groups.filter("link").select(F.col("a").alias("src"), F.col("b").alias("dst")))

        # groups near enough for their members to link, and not yet connected
        open_ = groups.filter((~F.col("link")) & (F.col("slack") > 0) & (F.col("distance") <= LIMIT + F.col("slack")))
        if open_.isEmpty():
            return links
        linked = stored(links, "links")
        nodes = linked.select(F.col("src").alias("node")).union(linked.select(F.col("dst").alias("node"))).distinct()
        label = stored(components(nodes, linked), "labels")
        of = lambda c: label.select(F.col("node").alias(c), F.col("component").alias(f"c{c}"))
        open_ = open_.join(of("a"), "a", "left").join(of("b"), "b", "left")
        open_ = open_.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b", F.col("distance").alias("apart"))
        rows = of_set.drop("n").join(bits, "set_key")
        # a member near a member of the other group is no farther from that group's leader than its width allows
        ends = open_.join(leads.withColumnRenamed("lead", "b"), "b").select("a", "b", "apart", "width", "n", *BITS)
        reach = (F.col("o.apart") <= LIMIT + F.col("x.distance") + F.col("o.width")) & (_least_distance("x", "o") <= LIMIT + F.col("o.width"))
        left = rows.alias("x").join(ends.alias("o"), (F.col("x.lead") == F.col("o.a")) & reach)
        pairs = left.join(
            rows.alias("y"),
            (F.col("o.b") == F.col("y.lead"))
            & (DEN * F.col("x.n") >= NUM * F.col("y.n")) & (DEN * F.col("y.n") >= NUM * F.col("x.n"))
            & (F.col("o.apart") <= LIMIT + F.col("x.distance") + F.col("y.distance")) & (_least_distance("x", "y") <= LIMIT),
        )
        members = self.compare(pairs.select(F.col("x.set_key").alias("a"), F.col("y.set_key").alias("b")).distinct(), "member")
        return linked.unionByName(members.filter("link").select(F.col("a").alias("src"), F.col("b").alias("dst")))

    def result(self) -> DataFrame:
        """(doc_id, text_hash, n_shingles, component_id, keeper) for each row; keeper is the first row of the component, by id and hash of the text."""
        edges = stored(self.edges(), "edges")
        nodes = edges.select(F.col("src").alias("node")).union(edges.select(F.col("dst").alias("node"))).distinct()
        group = components(nodes, edges).select(F.col("node").alias("set_key"), "component")
        joint = self.classes.join(group, "set_key", "left").withColumn("component", F.coalesce("component", "set_key"))
        least = joint.groupBy("component").agg(F.min("rep").alias("keeper"), F.sum("copies").alias("members"))
        # only sets with company need a look-up; AQE splits the rows of a set that many documents share
        table = joint.join(least.filter("members > 1"), "component").select("set_key", "keeper")
        found = self.members.join(stored(table, "answer"), "set_key", "left")
        return found.select("doc_id", "text_hash", "n_shingles", F.coalesce("keeper.doc_id", "doc_id").alias("component_id"), "keeper")


def text_hash() -> Column:
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs`` (doc_id, text).

    Null, empty or blank texts have n_shingles 0 and are linked with nothing. A text
    of fewer than five words is one shingle. Rows with equal sets, also repeated
    rows, link. A row with a null doc_id links like any other; its component_id is null if no row of its component has a
    doc_id. Other columns are ignored; an empty table gives an empty result.
    """
    return _Join(docs).result().select("doc_id", "n_shingles", "component_id")


def nearest_removed(docs: DataFrame) -> DataFrame:
    """The documents of which each component keeps its first row, by doc_id (null ids last) and hash of the text.

    Rows with the same doc_id and text are one document, and stay or go together. Other texts under the
    doc_id of a row that goes are documents of their own.
    """
    rows = _Join(docs).result().filter("keeper IS NOT NULL")
    first = F.col("keeper.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("keeper.text_hash") == F.col("text_hash"))
    gone = rows.filter(~first).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    gone = small_side(stored(gone, "removed"))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_id")) & (text_hash() == F.col("_hash"))
    return docs.join(gone, same, "left_anti").select(docs.columns)
