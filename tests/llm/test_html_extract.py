"""Page extraction: the reader on odd markup, the field against sums over all label sequences, and held-out accuracy."""

import html
import itertools
import re

import numpy as np
import pytest

from sparkwell.llm import html_extract as he
from sparkwell.llm.queries import QUERIES

SCHEMA = "page_id bigint, url string, html string, text string, n_chars string, lang string"


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return he.learn(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def texts(page):
    return [b.text for b in he.read_blocks(page)]


@pytest.mark.parametrize(
    "page, wanted",
    [
        ("", []),
        ("no tags  at\nall", ["no tags at all"]),
        ("<p>a <b>b</b>c<p>d", ["a bc", "d"]),
        ("<p>a<br>b<hr/>c</p>", ["a", "b", "c"]),
        ("<p>x &lt; y &amp;&eacute;&#233;&#x41; &amp</p>", ["x < y &ééA &"]),
        ("<script>var t='</p><p>no';</script><p>yes</p><style>p{}</style>", ["yes"]),
        ("<head><title>no</title><p>yes", ["yes"]),
        ("<head><title>no</title><body>yes", ["yes"]),
        ("a<!-- <p>no</p> -->b<!doctype x><?php no ?>c", ["abc"]),
        ('<p title="a > b">x</p><p title=it\'s>y</p>', ["x", "y"]),
        ('<p title="never closed>x</p> y > z', ["x", "y > z"]),
        ("<div hidden>no</div><div>yes</div>", ["yes"]),
        ("1 < 2 <3 </ 4 <p>x", ["1 < 2 <3 </ 4", "x"]),
        ("x <!-- open", ["x"]),
        ("<p>x</p><p cut", ["x"]),
        ("</p></div>x<textarea><p>no</textarea>y", ["x", "y"]),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", ["a", "b", "c", "d"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("<p>a  \t b</p>", ["a b"]),
    ],
)
def test_blocks(page, wanted):
    assert texts(page) == wanted


def test_path_and_names():
    (one, two) = he.read_blocks('<div class="Main-Content x2" id=top><p>a <a href="#">link</a></p></div><footer role="note">z</footer>')
    assert one.path == ("div", "p") and set(one.names) == {"main", "content", "x", "top"} and one.linked == 4
    assert two.path == ("footer",) and two.names == ("note",) and two.linked == 0


@pytest.mark.parametrize("piece", ['<a href="x ', "<", "</", "<div>", "<b>x", "<!-- x", "<script>x", "<p>a. &amp; ", "<a b=== c='", "<title>"])
def test_odd_pages_take_linear_time(piece):
    import time

    begin = time.time()
    he.features(he.read_blocks(piece * (600_000 // len(piece))))
    assert time.time() - begin < 20


def test_deep_pages():
    page = "<div>" * 5000 + "<p>x</p>" + "</div>" * 5000 + "<p>y</p>"
    assert texts(page) == ["x", "y"]


def test_decoding_and_training_against_all_sequences():
    """Viterbi gives the best of all label sequences; training raises the likelihood of the labels."""
    rnd = np.random.default_rng(0)
    names = list("abcdef")
    pages = [([list(rnd.choice(names, 2, replace=False)) for _ in range(5)], rnd.integers(0, 2, 5).tolist()) for _ in range(12)]
    pages += [([["a"], ["b"]], [1, 0])] * 6
    field = he.train(pages)

    def score(rows, labels, f):
        total = f.begin[labels[0]] + sum(f.weights[n][y] for row, y in zip(rows, labels) for n in row)
        return total + sum(f.pairs[a][b] for a, b in zip(labels, labels[1:]))

    def log_p(f):
        total = 0
        for rows, labels in pages:
            every = [score(rows, y, f) for y in itertools.product((0, 1), repeat=len(rows))]
            total += score(rows, labels, f) - np.logaddexp.reduce(every)
        return total

    for rows, _ in pages:
        best = max(itertools.product((0, 1), repeat=len(rows)), key=lambda y: score(rows, y, field))
        assert score(rows, field.decode(rows), field) == pytest.approx(score(rows, best, field))
    nothing = he.Field(dict.fromkeys(field.weights, (0.0, 0.0)), ((0.0, 0.0), (0.0, 0.0)), (0.0, 0.0))
    assert log_p(field) > log_p(nothing) + 3
    assert field.decode([]) == [] and nothing.decode([["a"]]) == [0]


def test_held_out_layouts(model):
    """Pages of other layouts, with the article in any element, and furniture of every kind."""
    right = total = whole = 0
    for page, wanted in he.composed_pages(150, seed=77):
        blocks, labels = he._labelled(page, wanted)
        assert len(blocks) == len(wanted)
        found = model.decode(he.features(blocks))
        right += sum(a == b for a, b in zip(found, labels))
        total += len(labels)
        whole += found == labels
    assert right / total > 0.98 and whole > 130


def test_whole_articles_of_the_table(spark, sf_dir, model):
    """Every page against its marked article, read by pattern."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in he.extract(pages, model).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        inside = re.search("<article>(.*)</article>", r["html"], re.S)[1]
        wanted = html.unescape(re.sub("<(?!/?b>)[^>]*>", " ", inside).replace("<b>", "").replace("</b>", ""))
        assert got[r["page_id"]] == " ".join(wanted.split())


def test_furniture_goes_and_quoted_furniture_stays(model):
    page = """<html><head><title>T</title></head><body><header><h1>My Site</h1></header><nav><a href=/>Home</a></nav>
    <div class="cookie-notice"><p>We use cookies to make this site better.</p><button>OK</button></div>
    <div class="content"><h2>Big news today</h2><p>The first paragraph tells what happened. It has two sentences.</p><p>All rights reserved.</p>
    <p>Short.</p><p>The last one, with a <a href="/x">link</a> in it, ends the story.</p></div>
    <aside class="sidebar"><h3>Related</h3><ul><li><a href=/a>Other story</a></li></ul></aside>
    <form class="search"><label>Search</label><button>Go</button></form>
    <section class="comments"><h3>Comments</h3><div class="comment"><p>I disagree with all of this. It is wrong.</p></div></section>
    <footer><p>&copy; My Site</p></footer></body></html>"""
    wanted = "Big news today The first paragraph tells what happened. It has two sentences. All rights reserved. Short. The last one, with a link in it, ends the story."
    assert he.main_text(page, model) == wanted


def test_nulls_repeats_other_columns_and_empty_tables(spark, model):
    page = "<article><p>One whole sentence stands here. And another one.</p></article><footer>&copy; x</footer>"
    rows = [(1, "u", page, "t", "n", "l"), (1, "u", page, "t", "n", "l"), (2, None, None, "t", "n", "l"), (None, "u", "", "t", "n", "l"), (3, "u", "<p>" * 50, "t", "n", "l")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, he.extract(df, model).collect()), key=str)
    said = "One whole sentence stands here. And another one."
    assert got == sorted([(1, "u", said, len(said))] * 2 + [(2, None, "", 0), (None, "u", "", 0), (3, "u", "", 0)], key=str)
    empty = df.filter("page_id = 99")
    assert he.extract(empty, he.learn(empty)).collect() == []


def test_query_has_its_columns(spark, sf_dir):
    assert QUERIES["op13_html_extraction"](spark, sf_dir).dtypes == [("page_id", "bigint"), ("url", "string"), ("text", "string"), ("n_chars", "bigint")]
