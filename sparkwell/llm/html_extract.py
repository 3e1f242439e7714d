"""Main text of web pages by a linear-chain conditional random field over DOM leaf blocks.

A page is read into leaf blocks: runs of text between block-level tags, each with the path of its open
elements. Scripts, styles and other elements without visible text give no blocks. Each block has binary features: the tags of its
ancestors, the words of their class, id and role attributes, and the shape of its text (length, links, end of sentence,
digits, capitals, neighbouring words such as a copyright sign). The field has the labels MAIN and OTHER, weights for each
feature and label, and for each pair of labels in a row; Viterbi gives the best sequence of a page, whose MAIN blocks make its text.

Training reads labelled pages of two kinds: pages composed here from site layouts, whose blocks are labelled as they are
made, and a sample of at most ``SAMPLE_PAGES`` input pages of at most ``SAMPLE_CHARS`` characters that mark their article with a tag,
each also with that tag hidden and without what stands before it, so that the field leans on neither alone. The log-likelihood is climbed by
AdaGrad over gradients from the forward-backward recursion.
"""

from __future__ import annotations

import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkwell.llm.text import slices

OTHER, MAIN = 0, 1
SAMPLE_PAGES, SAMPLE_CHARS = 150, 50_000
COMPOSED_PAGES = 400
ROUNDS, RATE, RIDGE = 12, 0.5, 1e-4

#: Fixed values of HTML: elements that hold no visible text, that end with their start tag, and that stand within a line.
HIDDEN = frozenset("script style noscript template svg math head title iframe object canvas audio video select textarea datalist".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
HEAD = frozenset("base link meta title style script noscript template head".split())
#: Elements whose content is text up to their own end tag.
RAW = frozenset("script style textarea title iframe noscript xmp noembed noframes".split())

#: A tag with attributes; a quoted value may hold ">". The plain form serves pages with an open quote.
_TAG = re.compile(r"<(?:!--(?P<comment>)|(?P<other>[!?])|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>)")
_PLAIN = re.compile(r"<(?:!--(?P<comment>)|(?P<other>[!?])|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>[^>]*+)>)")
_ATTR = re.compile(r"""(?<![\w-])(class|id|role|hidden|aria-hidden)\b(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""", re.I)
_SPACE = re.compile(r"\s+")
_NAMES = re.compile(r"[a-z]+")
_SENTENCE = re.compile(r"[.!?…](?:[\"'»”)]*)(?:\s|$)")


@dataclass
class Block:
    text: str
    path: tuple[str, ...]  # tags of the ancestors, outermost first
    names: tuple[str, ...]  # words of their class, id and role
    linked: int  # characters within links


@dataclass
class _Page:
    """The open elements and the text of the current block."""

    blocks: list[Block] = field(default_factory=list)
    open: list[tuple[str, tuple[str, ...]]] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    count: Counter[str] = field(default_factory=Counter)  # of the open tags
    linked: int = 0
    hidden: int = 0

    def add(self, text: str) -> None:
        if self.hidden or not text:
            return
        text = html.unescape(text) if "&" in text else text
        self.text.append(text)
        if self.count["a"]:
            self.linked += len(text)

    def close(self) -> None:
        """Ends the block; one without visible text is none."""
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            path = tuple(tag for tag, _ in self.open)
            names = tuple(dict.fromkeys(n for _, given in self.open for n in given))
            self.blocks.append(Block(text, path, names, self.linked))
        self.text, self.linked = [], 0

    def start(self, tag: str, attrs: str) -> None:
        if tag not in INLINE:
            self.close()
        if tag in VOID:
            return
        if tag not in HEAD:
            self._end_if_open("head", ("body",))
        # a block within a paragraph ends it; list items, cells and options end their like
        if tag not in INLINE:
            self._end_if_open("p", ("article", "section", "div", "td", "body", "blockquote", "li", "main"))
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            self._end_if_open(tag, ("ul", "ol", "dl", "table", "select"))
        given, out_of_sight = (), tag in HIDDEN
        if attrs.strip():
            words: list[str] = []
            for name, *values in _ATTR.findall(attrs):
                name, value = name.lower(), "".join(values).lower()
                if name == "hidden" or (name == "aria-hidden" and value == "true"):
                    out_of_sight = out_of_sight or name == "hidden"
                else:
                    words += _NAMES.findall(html.unescape(value))
            given = tuple(words)
        if len(self.open) < MAX_DEPTH:
            self.open.append((tag, (*given, "?hidden") if out_of_sight else given))
            self.count[tag] += 1
            self.hidden += out_of_sight

    def _pop(self) -> None:
        tag, names = self.open.pop()
        self.count[tag] -= 1
        self.hidden -= bool(names) and names[-1] == "?hidden"

    def _end_if_open(self, tag: str, within: tuple[str, ...]) -> None:
        if not self.count[tag]:
            return
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name == tag:
                # text styles that the page never closed end with their paragraph
                while len(self.open) > at:
                    self._pop()
                return
            if name in within:
                return

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self.close()
        if self.count[tag]:
            while self.open[-1][0] != tag:
                self._pop()
            self._pop()


#: Elements open at once; deeper ones are read but not kept on the path.
MAX_DEPTH = 400


def read_blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order, in one pass over its text; any text is a page."""
    out, at, pattern = _Page(), 0, _TAG
    while True:
        begin = page.find("<", at)
        if begin < 0:
            out.add(page[at:])
            break
        out.add(page[at:begin])
        found = pattern.match(page, begin)
        if not found and pattern is _TAG and re.match(r"</?[a-zA-Z]", page[begin : begin + 3]):
            pattern = _PLAIN  # a quote is never closed: from here on quotes do not count
            found = pattern.match(page, begin)
        if not found:
            if re.match(r"</?[a-zA-Z]", page[begin : begin + 3]):
                break  # a tag that the end of the page cuts off
            out.add("<")
            at = begin + 1
            continue
        at = found.end()
        if found["comment"] is not None:
            stop = page.find("-->", at)
            if stop < 0:
                break  # an open comment takes the rest of the page
            at = stop + 3
        elif found["other"] is not None:
            stop = page.find(">", at)
            if stop < 0:
                break
            at = stop + 1
        else:
            tag, attrs = found["name"].lower(), found["attrs"]
            if found["end"]:
                out.end(tag)
                continue
            out.start(tag, attrs)
            if attrs.endswith("/") and tag in ("svg", "math"):
                out.end(tag)
            elif tag in RAW:
                stop = _end_of_raw(page, tag, at)
                if tag not in HIDDEN:
                    out.add(page[at:stop])
                at = stop
                if at >= len(page):
                    break
    out.close()
    return out.blocks


def _end_of_raw(page: str, tag: str, at: int) -> int:
    found = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(page, at)
    return found.start() if found else len(page)


#: Words that furniture of pages holds in the site's own voice.
_CUES = re.compile(
    r"©|®|&copy;|\b(?:cookies?|copyright|all rights reserved|subscribe|newsletter|sign (?:in|up)|log ?in|share|tweet|reply|comments?|advertisement|sponsored|"
    r"privacy|terms|read more|related|menu|home|search|follow us|datenschutz|impressum|anmelden|werbung|accueil|publicité|inicio|publicidad)\b",
    re.I,
)


def _steps(n: int, name: str) -> str:
    return f"{name}{min(int(math.log2(n + 1)), 11)}"


def features(blocks: list[Block]) -> list[list[str]]:
    """The names of the features that each block of a page has."""
    out = []
    for b in blocks:
        words = b.text.count(" ") + 1
        size = len(b.text)
        mine = [f"leaf={b.path[-1] if b.path else ''}", _steps(words, "words"), _steps(size, "size")]
        mine += [f"in={t}" for t in set(b.path)]
        mine += [f"named={n}" for n in b.names]
        mine.append(f"linked{int(4 * b.linked / size + 0.001)}")
        ends = len(_SENTENCE.findall(b.text))
        mine.append(f"ends{min(ends, 3)}")
        if b.text[-1] in ".!?…":
            mine.append("stops")
        if words < 40 and _CUES.search(b.text):
            mine.append("cue")
        digits = sum(map(b.text.count, "0123456789"))
        if digits * 4 > size:
            mine.append("digits")
        if b.text[:1].islower():
            mine.append("lower")
        if "|" in b.text or "›" in b.text or "»" in b.text or "·" in b.text:
            mine.append("bars")
        out.append(mine)
    return out


@dataclass
class Field:
    """Weights of a trained field: (OTHER, MAIN) for each feature, and for each pair of labels in a row."""

    weights: dict[str, tuple[float, float]]
    pairs: tuple[tuple[float, float], tuple[float, float]]
    begin: tuple[float, float]

    def decode(self, rows: list[list[str]]) -> list[int]:
        """The best sequence of labels; ties go to OTHER."""
        if not rows:
            return []
        (oo, om), (mo, mm) = self.pairs
        known, back = self.weights, []
        other, main = self.begin
        for i, names in enumerate(rows):
            if i:
                stay, turn = other + oo, main + mo
                stay_m, turn_m = other + om, main + mm
                back.append((MAIN if turn > stay else OTHER, MAIN if turn_m > stay_m else OTHER))
                other, main = max(stay, turn), max(stay_m, turn_m)
            for name in names:
                w = known.get(name)
                if w:
                    other += w[0]
                    main += w[1]
        label = MAIN if main > other else OTHER
        labels = [label]
        for choice in reversed(back):
            label = choice[label]
            labels.append(label)
        return labels[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], seed: int = 5) -> Field:
    """A field from pages of (features of each block, label of each block)."""
    names = {n: i for i, n in enumerate(sorted({n for rows, _ in pages for names in rows for n in names}))}
    data = [([np.array([names[n] for n in row]) for row in rows], np.array(labels)) for rows, labels in pages if rows]
    w = np.zeros((len(names), 2))
    move = np.zeros((2, 2))
    begin = np.zeros(2)
    seen = [np.full_like(x, 1e-6) for x in (w, move, begin)]
    rnd = random.Random(seed)
    for _ in range(ROUNDS):
        rnd.shuffle(data)
        for rows, labels in data:
            n = len(rows)
            at = np.concatenate(rows)
            owner = np.repeat(np.arange(n), [len(r) for r in rows])
            unary = np.zeros((n, 2))
            np.add.at(unary, owner, w[at])
            ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
            ahead[0] = begin + unary[0]
            for i in range(1, n):
                ahead[i] = unary[i] + np.logaddexp(ahead[i - 1, 0] + move[0], ahead[i - 1, 1] + move[1])
            for i in range(n - 2, -1, -1):
                after = unary[i + 1] + behind[i + 1]
                behind[i] = np.logaddexp(move[:, 0] + after[0], move[:, 1] + after[1])
            log_z = np.logaddexp(*ahead[-1])
            p = np.exp(ahead + behind - log_z)
            gap = np.zeros((n, 2))
            gap[np.arange(n), labels] = 1
            gap -= p
            step_w = np.zeros_like(w)
            np.add.at(step_w, at, gap[owner])
            both = np.zeros((2, 2))
            if n > 1:
                pair = np.exp(ahead[:-1, :, None] + move + (unary[1:] + behind[1:])[:, None, :] - log_z)
                np.add.at(both, (labels[:-1], labels[1:]), 1)
                both -= pair.sum(0)
            touched = np.unique(at)
            for x, step, memory, rows_ in ((w, step_w, seen[0], touched), (move, both, seen[1], slice(None)), (begin, gap[0], seen[2], slice(None))):
                g = step[rows_] - RIDGE * x[rows_]
                memory[rows_] += g * g
                x[rows_] += RATE * g / np.sqrt(memory[rows_])
    return Field({n: (float(w[i, 0]), float(w[i, 1])) for n, i in names.items()}, tuple(map(tuple, move.tolist())), tuple(begin.tolist()))


# --- labelled pages


_SYLLABLES = "an be co de el en er es ge ha in ka la le li lo ma ne ou ra re sa st te ti to un ve wi za".split()


class _Writer:
    """Composes one labelled page."""

    def __init__(self, rnd: random.Random):
        self.rnd, self.parts, self.wanted = rnd, [], []

    def words(self, least: int, most: int) -> str:
        rnd = self.rnd
        word = lambda: "".join(rnd.choice(_SYLLABLES) for _ in range(rnd.randint(1, 4)))
        return " ".join(word() for _ in range(rnd.randint(least, most)))

    def prose(self, sentences: int) -> str:
        return " ".join(self.words(1, 18).capitalize() + self.rnd.choice([".", ".", ".", "?", "!", ","]) for _ in range(sentences))

    def block(self, tag: str, text: str, main: bool, inner: str | None = None, attrs: str = "") -> None:
        end = "" if tag == "p" and self.rnd.random() < 0.15 else f"</{tag}>"
        self.parts.append(f"<{tag}{attrs}>{inner or text}{end}")
        self.wanted.append((text, main))

    def links(self, n: int, tag: str = "li") -> None:
        for _ in range(n):
            text = self.words(1, 3).capitalize()
            self.block(tag, text, False, f'<a href="/{text}">{text}</a>')

    def within(self, tag: str, names: list[str], fill) -> None:
        names = [n for n in names if n]
        name = self.rnd.choice(names) if names else ""
        attr = f' {self.rnd.choice(["class", "class", "id"])}="{name}"' if name else ""
        self.parts.append(f"<{tag}{attr}>")
        fill()
        self.parts.append(f"</{tag}>")

    def article(self) -> None:
        rnd = self.rnd
        if rnd.random() < 0.85:
            self.block(rnd.choice(["h1", "h1", "h2"]), self.words(2, 12).capitalize(), True)
        for _ in range(rnd.randint(1, 14)):
            kind = rnd.random()
            if kind < 0.70:
                text = self.prose(rnd.choice([1, 1, 2, 4, 8, 12]))
                inner = text
                if rnd.random() < 0.25:
                    head, _, rest = text.partition(" ")
                    inner = rnd.choice([f"<b>{head}</b> {rest}", f"<b>{text}", f'<a href="#n">{head}</a> {rest}', f"<em>{head}</em> {rest}"]) if rest else text
                self.block("p", text, True, inner)
            elif kind < 0.76:
                self.block(rnd.choice(["h2", "h3"]), self.words(1, 7).capitalize(), True)
            elif kind < 0.82:
                self.parts.append("<ul>")
                for _ in range(rnd.randint(2, 5)):
                    self.block("li", self.words(3, 14).capitalize(), True)
                self.parts.append("</ul>")
            elif kind < 0.86:
                self.block("p", " | ".join(self.words(1, 1) for _ in range(rnd.randint(2, 30))), True)
            elif kind < 0.90:
                self.block("blockquote", self.prose(2), True)
            elif kind < 0.92:
                self.block("p", self.words(1, 2).capitalize() + ".", True)
            elif kind < 0.94:
                # articles also quote what furniture says
                said = rnd.choice(["All rights reserved.", "Copyright.", "Subscribe.", "Read more.", "Share this.", "Cookies.", "Privacy and terms.", "Log in.", "Comments."])
                self.block("p", rnd.choice([said, f"© {self.words(1, 3)}", f"{self.words(1, 8)} {said}"]), True)
            elif kind < 0.97:
                self.within("aside", ["related", "promo", "", "pullout"], lambda: self.links(rnd.randint(1, 3), "p"))
            else:
                self.within("div", ["ad", "advert", "sponsored", "banner", "ads"], lambda: self.block("p", self.prose(1), False))

    def furniture(self, kind: str) -> None:
        rnd = self.rnd
        tag, names = rnd.choice(LAYOUT[kind])
        getattr(self, f"_{kind}")(tag, names.split() + [""] * (tag not in ("div", "section", "ol")))

    def _nav(self, tag, names):
        self.within(tag, names, lambda: self.within("ul", [], lambda: self.links(self.rnd.randint(1, 8))))

    def _header(self, tag, names):
        def fill():
            self.block(self.rnd.choice(["h1", "div", "p"]), self.words(1, 5).capitalize(), False)
            self.links(self.rnd.randint(0, 3), "p")

        self.within(tag, names, fill)

    def _footer(self, tag, names):
        def fill():
            text = f"© {self.words(1, 3)} · {self.prose(self.rnd.randint(1, 2))}"
            self.block("p", text, False, text.replace("©", "&copy;").replace("·", "&middot;"))
            self.links(self.rnd.randint(0, 3), "p")

        self.within(tag, names, fill)

    def _aside(self, tag, names):
        def fill():
            self.block("h3", self.words(1, 3).capitalize(), False)
            self.links(self.rnd.randint(0, 5))
            if self.rnd.random() < 0.6:
                self.block("p", self.prose(self.rnd.randint(1, 4)), False)

        self.within(tag, names, fill)

    def _notice(self, tag, names):
        def fill():
            said = self.rnd.choice(["We use cookies. ", "This site uses cookies. ", "Subscribe to our newsletter. ", "", ""])
            self.block("p", said + self.prose(self.rnd.randint(1, 3)), False)
            self.block("button", self.words(1, 2), False)

        self.within(tag, names, fill)

    def _ad(self, tag, names):
        self.within(tag, names, lambda: self.block(self.rnd.choice(["p", "div"]), self.prose(self.rnd.randint(1, 3)), False))

    def _form(self, tag, names):
        def fill():
            self.block("label", self.words(1, 5).capitalize(), False)
            self.parts.append("<input name=q>")
            self.block("button", self.words(1, 2).capitalize(), False)

        self.within(tag, names, fill)

    def _comments(self, tag, names):
        def fill():
            if self.rnd.random() < 0.6:
                self.block("h3", self.rnd.choice(["Comments", "Reader comments", "3 comments", self.words(1, 2)]), False)
            for _ in range(self.rnd.randint(1, 5)):
                self.within(self.rnd.choice(["div", "li", "article", "section"]), ["comment", "comment", "reply"], lambda: self.block("p", self.prose(self.rnd.randint(1, 5)), False))

        self.within(tag, names, fill)


#: Elements and class names that sites use for what is not the article.
LAYOUT = {
    "nav": [("nav", "menu nav"), ("nav", "navbar breadcrumb"), ("div", "menu nav navbar navigation breadcrumb")],
    "header": [("header", "header top"), ("header", "masthead site"), ("div", "header top masthead banner")],
    "footer": [("footer", "footer"), ("footer", "bottom"), ("div", "footer bottom legal copyright")],
    "aside": [("aside", "sidebar related"), ("aside", "widget"), ("div", "sidebar related widget side recommended promo")],
    "notice": [("div", "cookie consent notice banner popup modal alert newsletter cookies"), ("section", "notice cookie newsletter"), ("dialog", "consent")],
    "ad": [("div", "ad ads advert advertisement sponsored promo banner"), ("section", "ad sponsored"), ("div", "ad ads")],
    "form": [("form", "search login signup contact"), ("form", "subscribe")],
    "comments": [("section", "comments discussion replies"), ("div", "comments responses disqus"), ("ol", "comments commentlist")],
}


def composed_pages(n: int, seed: int = 11) -> Iterator[tuple[str, list[tuple[str, bool]]]]:
    """(page, [(text of a block, whether it is main)]) for ``n`` layouts, always the same ones."""
    for i in range(n):
        rnd = random.Random(f"{seed}-{i}")
        w = _Writer(rnd)
        w.parts.append("<!DOCTYPE html><html><head><title>" + w.words(2, 6) + "</title><style>p{margin:0}</style></head><body>")
        # some pages begin or end with their article
        bare_before, bare_after = rnd.random() < 0.3, rnd.random() < 0.3
        before = [k for k in ("header", "nav", "notice", "ad", "form", "aside") if not bare_before and rnd.random() < (0.6 if k in ("header", "nav") else 0.3)]
        after = [k for k in ("comments", "aside", "ad", "form", "notice", "nav", "footer") if not bare_after and rnd.random() < (0.75 if k == "footer" else 0.3)]
        for kind in before:
            w.furniture(kind)
        tag = rnd.choice(["article", "article", "main", "div", "section", "div"])
        names = ["content", "article", "post", "entry", "main", "story", "body", "text"] + ["", ""] * (tag in ("article", "main"))
        if rnd.random() < 0.2:
            w.parts.append('<div class="wrapper">')
        w.within(tag, names, w.article)
        for kind in after:
            w.furniture(kind)
        if rnd.random() < 0.8:
            w.parts.append("</body></html>")
        yield "".join(w.parts), w.wanted


def _labelled(page: str, wanted: list[tuple[str, bool]]) -> tuple[list[Block], list[int]]:
    """The blocks of a composed page with their labels, in order."""
    blocks = read_blocks(page)
    labels = iter(wanted)
    said, kept = [], []
    for b in blocks:
        text, main = next(labels)
        while _SPACE.sub(" ", text).strip() != b.text:
            text, main = next(labels)
        said.append(int(main))
        kept.append(b)
    return kept, said


#: Fixed values of HTML: elements that mark an article, and those that mark what is none within it.
_MARKS = ("article", "main")
_NO_ARTICLE = frozenset("nav footer aside form header".split())


def _by_mark(page: str) -> tuple[list[Block], list[int]] | None:
    """The blocks of a page that has one kind of mark, labelled by it; None if it has no mark or nothing outside."""
    blocks = read_blocks(page)
    labels = [int(any(t in _MARKS for t in b.path) and not _NO_ARTICLE.intersection(b.path)) for b in blocks]
    return (blocks, labels) if 0 < sum(labels) < len(labels) else None


def _unmarked(blocks: list[Block]) -> list[Block]:
    return [Block(b.text, tuple("div" if t in _MARKS else t for t in b.path), b.names, b.linked) for b in blocks]


def learn(pages: DataFrame) -> Field:
    """A field trained on composed pages and on a sample of ``pages`` (page_id, html) by hash of the id."""
    rows = pages.select(F.col("page_id").cast("string").alias("id"), F.col("html").cast("string").alias("html"))
    rows = rows.filter((F.length("html") <= SAMPLE_CHARS) & F.col("html").rlike("(?i)<(article|main)\\b"))
    picked = rows.orderBy(F.crc32(F.coalesce("id", F.lit(""))), "id", "html").limit(SAMPLE_PAGES).collect()
    data = []
    for page, wanted in composed_pages(COMPOSED_PAGES):
        blocks, labels = _labelled(page, wanted)
        data.append((features(blocks), labels))
    for row in picked:
        marked = _by_mark(row["html"])
        if marked:
            blocks, labels = marked
            begin = labels.index(MAIN)
            data += [(features(blocks), labels), (features(_unmarked(blocks)), labels), (features(blocks[begin:]), labels[begin:])]
    return train(data)


def main_text(page: str | None, model: Field) -> str:
    """The main blocks of a page, joined by one space."""
    blocks = read_blocks(page or "")
    return " ".join(b.text for b, label in zip(blocks, model.decode(features(blocks))) if label == MAIN)


def extract(pages: DataFrame, model: Field) -> DataFrame:
    """(page_id, url, text, n_chars) for each row of ``pages`` (page_id, url, html).

    Null or empty pages, and pages without a main block, have the empty text. Text without any tag is one block, read like any
    other. Pages cut off within a tag or comment end there. Repeated rows give repeated results; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [main_text(page, model) for page in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(list(map(len, texts)), pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
