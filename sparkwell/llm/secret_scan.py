"""Secret scan with corpus-wide ownership, in DataFrame operations only.

Patterns find candidate spans in whole texts. The hash of each candidate's value is then counted
over the corpus by distinct owners and repositories: a value that many owners carry is a widely
copied example, one that few owners carry and that looks random is a live credential.

Positions come from splitting the text at the matches: lengths of the pieces and of the
matches add up to code point offsets. Only texts that pass one gate pattern are split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sparkwell.llm.common import small_side, stored


@dataclass(frozen=True)
class Kind:
    """``group``: what is hashed as the value; ``least``: characters it needs; ``base``: kept whatever its ownership."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False


WORD = r"[^\x20\x09-\x0D/:@]+"
#: In the order that breaks ties of position. The first three are the base kinds; the others count only if they look live.
KINDS = (
    Kind("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Kind("access", r"AKIA[A-Z0-9]{16,}", 0, 20, True),
    Kind("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Kind("forge", r"gh[opsur]_[A-Za-z0-9]{36,}", 0, 40),
    # bounded heads: a long run of letters is tried at each of its places
    Kind("bearer", r"eyJ[A-Za-z0-9_-]{8,1000}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 27),
    Kind("login", rf"[a-z]{{1,16}}://{WORD}:({WORD})@", 1, 6),
)
GATE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]|AKIA[A-Z0-9]{16}|[0-9a-f]{24}|gh[opsur]_[A-Za-z0-9]{36}|eyJ[A-Za-z0-9_-]{8}|://"""
#: A value of more owners or repositories than these is a copied example.
MAX_OWNERS, MAX_REPOSITORIES = 3, 6
#: A live-looking value has so many characters, a digit, and so many different characters.
LIVE_LENGTH, LIVE_DISTINCT = 12, 6
#: Rows up to which documents with spans are broadcast: some hundred bytes each.
CUT_ROWS = 50_000


def _matches(number: int, kind: Kind) -> Column:
    """[(kind, i, gap, size, value_sha256, length, live)]: each match with the number of code points since the one before.

    Values leave the text only as their hashes.
    """
    text, pattern = F.col("_text"), F.lit(kind.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    values = F.regexp_extract_all(text, pattern, F.lit(kind.group)) if kind.group else found
    pieces = F.split(text, kind.pattern, -1)
    rows = F.transform(
        F.arrays_zip(found.alias("m"), values.alias("v"), pieces.alias("p")),
        lambda x, i: F.struct(
            F.lit(number).alias("kind"), i.alias("i"), F.length(x["p"]).cast("bigint").alias("gap"),
            F.length(x["m"]).cast("bigint").alias("size"), F.sha2(x["v"], 256).alias("value_sha256"),
            F.length(x["v"]).alias("length"), _live(x["v"]).alias("live"),
        ),
    )
    # the piece after the last match has no match beside it
    return F.filter(rows, lambda x: x["size"].isNotNull())


def _live(value: Column) -> Column:
    letters = F.size(F.array_distinct(F.split(value, "")))
    return (F.length(value) >= LIVE_LENGTH) & value.rlike("[0-9]") & (letters >= LIVE_DISTINCT)


class Scan:
    """One scan of a table; ``repository`` and ``owner`` are columns or expressions of it."""

    def __init__(self, docs: DataFrame, repository: Column, owner: Column):
        text = F.coalesce(F.col("text").cast("string"), F.lit(""))
        rows = docs.select(F.col("doc_id"), text.alias("_text"), F.xxhash64(text).alias("text_hash"), repository.cast("string").alias("repository"), owner.cast("string").alias("owner"))
        kinds = F.concat(*[_matches(i, k) for i, k in enumerate(KINDS)])
        found = F.when(F.col("_text").rlike(GATE), kinds)
        rows = rows.select("doc_id", "text_hash", "repository", "owner", found.alias("found"))
        #: one row for each input row; the number stays with it as it is on shared files
        self.rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "scan")

    def spans(self) -> DataFrame:
        """(row, kind, start, end, value_sha256, owners, repositories, verdict) of all spans that count."""
        each = self.rows.filter("size(found) > 0").select("row", "owner", "repository", F.explode("found").alias("f")).select("row", "owner", "repository", "f.*")
        before = Window.partitionBy("row", "kind").orderBy("i")
        end = F.sum(F.col("gap") + F.col("size")).over(before)
        least = F.element_at(F.array(*[F.lit(k.least) for k in KINDS]), F.col("kind") + 1)
        spans = (
            each.withColumn("end", end).withColumn("start", F.col("end") - F.col("size")).filter(F.col("length") >= least)
            .select("row", "owner", "repository", "kind", "start", "end", "value_sha256", "live")
        )
        spans = stored(spans, "spans")
        # a value in a third of all texts is one row for each owner and repository before it is counted
        held = spans.groupBy("value_sha256", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
        counts = held.groupBy("value_sha256").agg(F.countDistinct("owner").alias("owners"), F.countDistinct("repository").alias("repositories"))
        counts = stored(counts, "ownership")
        copied = (F.col("owners") > MAX_OWNERS) | (F.col("repositories") > MAX_REPOSITORIES)
        verdict = F.when(copied, "example").when(F.col("live"), "live").otherwise("weak")
        base = F.col("kind") < sum(k.base for k in KINDS)
        judged = spans.join(small_side(counts, 100_000), "value_sha256").withColumn("verdict", verdict)
        return judged.filter(base | (F.col("verdict") == "live")).select("row", "kind", "start", "end", "value_sha256", "owners", "repositories", "verdict")

    def report(self) -> DataFrame:
        """One row for each input row: doc_id, counts by kind and verdict, base_sha256 and spans."""
        names = F.array(*[F.lit(k.name) for k in KINDS])
        by_row = self.spans().groupBy("row").agg(
            *[F.count(F.when(F.col("kind") == i, 1)).alias(f"n_{k.name}") for i, k in enumerate(KINDS) if k.base],
            *[F.count(F.when(F.col("verdict") == v, 1)).alias(f"n_{v}") for v in ("live", "example")],
            F.sort_array(F.collect_list(F.struct("start", "kind", "end", "verdict"))).alias("all"),
        )
        said = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"], x["end"])), ",")
        base = F.filter("all", lambda x: x["kind"] < sum(k.base for k in KINDS))
        out = self.rows.select("row", "doc_id").join(by_row, "row", "left")
        counts = [F.coalesce(f"n_{c}", F.lit(0)).cast("bigint").alias(f"n_{c}") for c in ("assign", "access", "hex")]
        more = [F.coalesce(f"n_{c}", F.lit(0)).cast("bigint").alias(f"n_{c}") for c in ("live", "example")]
        return out.select(
            "doc_id", *counts, F.sha2(F.coalesce(said(base), F.lit("")), 256).alias("base_sha256"), F.coalesce(said(F.col("all")), F.lit("")).alias("spans"), *more
        )


def scan_secrets(docs: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """The report of a scan: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_live, n_example.

    One row for each row of ``docs`` (doc_id, text), repeated rows too. Null counts as empty text; a
    null owner or repository is no owner or repository. Other columns are ignored, an empty
    table gives an empty result. Spans are kind:start:end, in code points, end exclusive.
    """
    return Scan(docs, repository, owner).report()


def redact(docs: DataFrame, repository: Column, owner: Column) -> DataFrame:
    """``docs`` with every span replaced: ``<secret>``, or ``<example>`` where the value is a widely copied example.

    Overlapping spans are replaced as one, as a secret if any of them is none. Rows and columns
    stay; n_chars, where it exists, is counted again for texts that changed.
    """
    scan = Scan(docs, repository, owner)
    by_start = Window.partitionBy("row").orderBy("start", "kind")
    reach = F.max("end").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    spans = scan.spans().withColumn("opens", F.coalesce(F.col("start") >= reach, F.lit(True)).cast("int"))
    spans = spans.withColumn("run", F.sum("opens").over(by_start))
    merged = spans.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.min((F.col("verdict") == "example").cast("int")).alias("example"))
    cuts = merged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "example"))).alias("_cuts"))
    # equal texts have equal spans, so a document is found again by its id and the hash of its text
    held = scan.rows.join(cuts, "row").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "_cuts")
    held = stored(held.groupBy("_id", "_hash").agg(F.min("_cuts").alias("_cuts")), "cuts")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))) == F.col("_hash"))
    out = docs.join(small_side(held, CUT_ROWS), same, "left")
    stop = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(F.col("_cuts"), i - 1)["end"]).cast("int")
    mark = lambda x: F.when(x["example"] == 1, F.lit("<example>")).otherwise(F.lit("<secret>"))
    parts = F.transform("_cuts", lambda x, i: F.concat(F.substring("text", stop(i) + 1, x["start"].cast("int") - stop(i)), mark(x)))
    rest = F.substring("text", F.element_at("_cuts", -1)["end"].cast("int") + 1, F.lit(2**31 - 1))
    text = F.when(F.col("_cuts").isNull(), F.col("text")).otherwise(F.concat(F.array_join(parts, ""), rest))
    cleaned = out.withColumn("text", text)
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.when(F.col("_cuts").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))
    return cleaned.select(docs.columns)
