"""SentencePiece pieces: streaming Viterbi encoding, and decoding, of whole texts.

The text gets a space in front and is cut into pieces of the model so that the sum of their scores is
largest. A character that is in no piece becomes the byte pieces of its UTF-8 form. The search keeps
a window of positions: a later piece can start only within the longest piece of the
current position, so once the best paths of all those positions run through one
boundary, the ids before it are final and are given out.

No piece has a space after another character (checked when the model is read). So
all paths meet where a space follows another character, and the pieces of a word do not depend on
its neighbours: words are kept in a bounded cache.

Equal sums are settled for the path whose last piece is longest. Scores are summed as integers in exact arithmetic.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHED_WORDS, CACHED_LENGTH = 300_000, 48
_LATIN, _MARKS = "A-Za-zÀ-ÖØ-öø-ɏ", ".,;:!?#$%&*"
_WORD = re.compile(r" +[^ ]*|[^ ]+")
#: Rows taken from a batch at a time: bounds the Python objects of a task.
SLICE = 256
#: Below any sum of scores that a path of pieces over one window can have.
UNKNOWN = -(10**12)


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score: dict[str, tuple[int, int]] = {}
        self.bytes: list[bytes] = []
        self.byte_id = [0] * 256
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_id[value] = i
                self.bytes.append(bytes([value]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.bytes.append(b"")
            else:
                text = piece.replace("▁", " ")
                self.score[text] = (round(model.get_score(i) * 1000), i)
                self.bytes.append(text.encode())
        self.longest = max(map(len, self.score))
        self.by_word = all(" " not in p.lstrip(" ") for p in self.score)
        # where no piece has a letter before a mark, nor a line feed, all paths meet there as well
        letter = re.compile(f"[{_LATIN}]")
        marks = "".join(m for m in _MARKS if not any(letter.match(a) and b == m for p in self.score for a, b in zip(p, p[1:])))
        self.cut = _WORD
        if not any("\n" in p for p in self.score):
            ends = re.escape(marks) + r" \n"
            self.cut = re.compile(rf" *[{_LATIN}]+(?=[{ends}]|\Z)|\n| +(?=\n|\Z)| *[^ \n]+")
        # every beginning of a piece, so that a search can stop where no piece goes on
        self.begins: dict[str, tuple[int, int] | None] = {p[:k]: None for p in self.score for k in range(1, len(p))}
        self.begins.update(self.score)
        self.known: dict[str, bytes] = {}

    def stream(self, text: Iterable[str]) -> Iterator[int]:
        """Ids of a text that comes character by character, given out as soon as they are final."""
        score, longest = self.score, self.longest
        recent = ""  # the characters of the window
        base = 0  # where the window begins: the last boundary that is final
        best, back, piece = [0], [0], [-1]  # by position from base on
        for char in text:
            recent += char
            end = len(recent)
            top, start, number = None, end - 1, -1
            for begin in range(max(0, end - longest), end):
                found = score.get(recent[begin:end])
                if found is not None and (top is None or best[begin] + found[0] > top):
                    top, start, number = best[begin] + found[0], begin, found[1]
            if char not in score and (top is None or best[end - 1] + UNKNOWN > top):
                top, start, number = best[end - 1] + UNKNOWN, end - 1, -1
            best.append(top)
            back.append(start)
            piece.append(number)
            if end >= 2 * longest:
                live = set(range(end - longest + 1, end + 1))
                while len(live) > 1:
                    last = max(live)
                    live.remove(last)
                    live.add(back[last])
                meet = live.pop()
                if meet:
                    yield from self._path(recent, back, piece, meet)
                    base += meet
                    recent = recent[meet:]
                    low = best[meet]
                    best = [x - low for x in best[meet:]]
                    back, piece = [max(x - meet, 0) for x in back[meet:]], piece[meet:]
        yield from self._path(recent, back, piece, len(recent))

    def _word(self, word: str) -> list[int]:
        """The same search over a text no longer than one window, forward from each position; it needs no early end."""
        begins, n = self.begins, len(word)
        best: list[int | None] = [None] * (n + 1)
        back, piece = [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0
        for begin in range(n):
            low = best[begin]
            for end in range(begin + 1, n + 1):
                found = begins.get(word[begin:end], -1)
                if found is None:
                    continue
                if found == -1:
                    break
                total, top = low + found[0], best[end]
                if top is None or total > top:
                    best[end], back[end], piece[end] = total, begin, found[1]
            if word[begin] not in self.score and (best[begin + 1] is None or low + UNKNOWN > best[begin + 1]):
                best[begin + 1], back[begin + 1], piece[begin + 1] = low + UNKNOWN, begin, -1
        return self._path(word, back, piece, n)

    def _path(self, recent: str, back: list[int], piece: list[int], end: int) -> list[int]:
        out: list[int] = []
        while end:
            start = back[end]
            if piece[end] >= 0:
                out.append(piece[end])
            else:
                out.extend(self.byte_id[b] for b in reversed(recent[start:end].encode("utf-8", "surrogatepass")))
            end = start
        return out[::-1]

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian 32-bit bytes; an empty text has none."""
        if not text:
            return b""
        if not self.by_word:
            return np.fromiter(self.stream(" " + text), "<u4").tobytes()
        known = self.known
        if len(known) > CACHED_WORDS:
            known.clear()
        out = []
        for word in self.cut.findall(" " + text):
            ids = known.get(word)
            if ids is None:
                found = self._word(word) if len(word) < 2 * self.longest else list(self.stream(word))
                ids = array("I", found).tobytes()
                if len(word) <= CACHED_LENGTH:
                    known[word] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        table = self.bytes
        text = b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])
        return (text[1:] if text[:1] == b" " else text).decode("utf-8", "replace")


_models: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


def encode_pieces(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` with ``ids``: the ids of ``text`` as little-endian 32-bit bytes, null for a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pieces(model)
        at = names.index("text")
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                part = batch.slice(begin, SLICE)
                ids = [None if t is None else codec.encode(t) for t in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.binary())], names=[*names, "ids"])

    rows = docs.drop("ids")
    names = rows.columns
    return rows.mapInArrow(run, rows.select("*", F.lit(None).cast("binary").alias("ids")).schema)


def decode_pieces(rows: DataFrame, model: str) -> DataFrame:
    """``rows`` with ``decoded``: the text of ``ids``, null for null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pieces(model)
        at = names.index("ids")
        for batch in batches:
            for begin in range(0, batch.num_rows, SLICE):
                part = batch.slice(begin, SLICE)
                texts = [None if x is None else codec.decode(x) for x in part.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    rows = rows.drop("decoded")
    names = rows.columns
    return rows.mapInArrow(run, rows.select("*", F.lit(None).cast("string").alias("decoded")).schema)


def round_trip(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, decoded_sha256, exact) for each row of ``docs`` (doc_id, text).

    Null counts as empty text, which has no ids and comes back exact. Repeated rows give repeated results.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    both = decode_pieces(encode_pieces(docs.select("doc_id", text.alias("text")), model), model)
    return both.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.col("text")).alias("exact"),
    )
