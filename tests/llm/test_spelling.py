"""Spelling variants against a plain version over every pair of words."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from sparkwell.llm import spelling

SCHEMA = "doc_id bigint, text string, word string, n int"


def plain(rows):
    """word -> (n, n_near, form, form_n, root), each word held against every other."""
    counts = Counter()
    for doc_id, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    holes = defaultdict(set)
    for w in words:
        holes[w].add(w)
        for i in range(len(w)):
            holes[w[:i] + w[i + 1 :]].add(w)
    near = defaultdict(set)
    for group in holes.values():
        for a in group:
            near[a] |= {b for b in group if a != b and one_edit(a, b)}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = {}
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (n, len(near[w]), form[w], words.get(form[w]), root)
    return out


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) + 1 == len(b) and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def found(df):
    rows = spelling.variant_groups(df).collect()
    out = {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in rows}
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("letters", ["ab", "abcdé", "etaonÿ"])
def test_against_every_pair(spark, letters):
    """Few letters make recurring bigrams, ties and chains."""
    rnd = random.Random(letters)
    stems = ["".join(rnd.choice(letters) for _ in range(rnd.randint(4, 9))) for _ in range(60)]
    words = []
    for stem in stems:
        words += [stem] * rnd.randint(1, 12)
        for _ in range(4):
            at = rnd.randrange(len(stem))
            words += [rnd.choice([stem[:at] + stem[at + 1 :], stem[:at] + rnd.choice(letters) + stem[at:], stem[:at] + rnd.choice(letters) + stem[at + 1 :]])] * rnd.randint(1, 5)
    rnd.shuffle(words)
    rows = [(i, " ".join(words[i::40]).upper() if i % 3 else "-".join(words[i::40])) for i in range(40)]
    rows += [rows[0], (None, " ".join(words[:50]))]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(4)
    assert found(df) == plain(rows)


def test_long_runs_and_long_tails(spark):
    """Words longer than the reach of a key and than what the edit distance is asked for, and one letter repeated."""
    rnd = random.Random(1)
    long = ["".join(rnd.choice("abcdefgh") for _ in range(80)) for _ in range(6)]
    words = []
    for w in long:
        for at in (0, 1, 30, 41, 78, 79):
            words += [w, w[:at] + w[at + 1 :], w[:at] + "z" + w[at:], w[:at] + "y" + w[at + 1 :]]
    words += ["a" * n for n in (5, 6, 7, 50, 51, 52)] + ["a" * 20 + "b" + "a" * 20, "a" * 41, "a" * 40]
    rows = [(i, " ".join(words) + " 語😀×÷ ") for i in range(4)]
    assert found(spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)) == plain(rows)


def test_very_long_words(spark):
    text = " ".join(["x" * 300_000, "x" * 300_001, "y" + "ab" * 150_000] * 3 + [""])
    got = found(spark.createDataFrame([(1, text, "x", 1)], SCHEMA))
    assert len(got) == 3
    assert sum(v[1] for v in got.values()) == 2


def test_pieces_cut_no_run(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PIECE", 7)
    text = "hello wörld hello/hello wörlds " * 20
    pieces = list(spelling._pieces(text.encode("latin-1")))
    assert b"".join(pieces) == text.encode("latin-1") and len(pieces) > 10
    assert sum((spelling._RUN.findall(p) for p in pieces), []) == spelling._RUN.findall(text.encode("latin-1"))


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None, "x", 1), (2, "", "x", 1), (3, " 12 a bc ", "x", 1)], SCHEMA)
    assert found(df) == {}
    assert found(df.filter("doc_id < 0")) == {}
    assert spelling.variant_groups(df).schema.simpleString() == "struct<word:string,n:bigint,n_near:bigint,form:string,form_n:bigint,root:string>"


def test_pivots_are_disjoint_and_rarest():
    rank = {g: (i, p) for i, (p, g) in enumerate(sorted([(5, "ab"), (1, "bc"), (2, "cd"), (9, "de"), (3, "ef")]))}
    assert spelling.prefix_and_pivots("abcdef", rank) == ([1, 2, 4], [1, 4])
