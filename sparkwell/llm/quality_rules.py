"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

``MEASURES`` are column expressions over a whole text, ``RULES`` bounds on ratios of them. ``compile_rules``
turns the table into one boolean column; a text is kept if it passes the base rule and
every row of the table. Nothing shuffles.

Words are runs of characters other than space and \\t \\n \\v \\f \\r. Repeated 5-word windows are found
by hash within a text: only texts in which some window occurs twice sort theirs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: Frequent function words of the languages of the corpus.
STOP_WORDS = (
    "the of and to in a is that it for on was with as be by this are "
    "der die das und ist den nicht von im mit ein sie es zu "
    "le la les des et en un une du que qui est pour dans "
    "el los las y de que se por con no su una"
).split()


@dataclass(frozen=True)
class Rule:
    """``name``: numerator over denominator between two bounds; empty denominators pass."""

    name: str
    over: str
    under: str
    least: float = float("-inf")
    most: float = float("inf")


#: Beyond the base rule: bounds that ordinary prose of any length meets.
RULES = (
    Rule("mean_word", "word_chars", "n_words", 2.0, 15.0),
    Rule("symbols", "n_symbols", "n_words", most=0.3),
    Rule("stop_words", "n_stop_words", "n_words", least=0.02),
    Rule("dup_lines", "n_dup_lines", "n_lines", most=0.5),
    Rule("no_letters", "n_plain_words", "n_words", least=0.5),
)
MIN_WORDS, MAX_REPEATED_PERCENT = 10, 20


def _counted(rows: DataFrame) -> DataFrame:
    """Words, lines and windows of ``_text`` as arrays; each is used more than once, so none is computed again."""
    words = F.filter(F.split("_text", f"{SPACE}+"), lambda w: w != "")
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumns({"_words": words, "_lines": lines}).withColumn("_n", F.size("_words"))
    window = F.transform(
        F.sequence(F.lit(0), F.col("_n") - WINDOW),
        lambda i: F.xxhash64(*[F.get(F.col("_words"), i + k) for k in range(WINDOW)]),
    )
    rows = rows.withColumn("_windows", F.when(F.col("_n") >= WINDOW, window).otherwise(F.array().cast("array<bigint>")))
    return rows.withColumn("_repeats", F.size(F.array_distinct("_windows")) < F.size("_windows"))


def _repeat_words() -> Column:
    """Words inside windows that occur twice or more, each word once."""
    pairs = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # bound as a lambda's variable, so that the sorted array is built once
    starts = F.get(
        F.transform(
            F.array(pairs),
            lambda s: F.sort_array(
                F.transform(
                    F.filter(s, lambda x, k: (F.get(s, k - 1)["h"].eqNullSafe(x["h"])) | (F.get(s, k + 1)["h"].eqNullSafe(x["h"]))),
                    lambda x: x["i"],
                )
            ),
        ),
        F.lit(0),
    )
    covered = F.get(
        F.transform(
            F.array(starts),
            lambda s: F.aggregate(
                F.transform(s, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(s, k + 1) - i, F.lit(WINDOW)))), F.lit(0).cast("bigint"), lambda a, x: a + x
            ),
        ),
        F.lit(0),
    )
    return F.when(F.col("_repeats"), covered).otherwise(F.lit(0).cast("bigint"))


def compile_rules(rules: tuple[Rule, ...] = RULES) -> Column:
    """The table as one boolean expression."""
    passed = F.lit(True)
    for rule in rules:
        ratio = F.try_divide(F.col(rule.over), F.col(rule.under))
        passed = passed & F.coalesce(ratio.between(rule.least, rule.most), F.lit(True))
    return passed


def measure(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ..., base_failed, kept) for each row.

    Null text counts as no words. A text of fewer than 10 words fails the base rule, also an empty
    one. Repeated rows give repeated results; other columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = _counted(docs.select("doc_id", text.alias("_text")))
    chars = F.length(F.regexp_replace("_text", f"{SPACE}+", ""))
    symbols = F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))
    stops = F.regexp_count(F.lower("_text"), F.lit(rf"(?<![^\x20\x09-\x0D])(?:{'|'.join(dict.fromkeys(STOP_WORDS))})(?![^\x20\x09-\x0D.,;:!?])"))
    # no letter at all: a word of symbols or digits
    bare = F.regexp_count("_text", F.lit(r"(?<![^\x20\x09-\x0D])[^\p{L}\x20\x09-\x0D]+(?![^\x20\x09-\x0D])"))
    out = rows.select(
        "doc_id",
        F.col("_n").cast("bigint").alias("n_words"),
        chars.cast("bigint").alias("word_chars"),
        symbols.cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        _repeat_words().alias("n_repeat_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        stops.cast("bigint").alias("n_stop_words"),
        (F.col("_n") - bare).cast("bigint").alias("n_plain_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return out.withColumn("base_failed", failed).withColumn("kept", (~F.col("base_failed")) & compile_rules(rules))
