"""Token ids of whole texts by the tokenizers library, with a bounded cache of what stands between white space."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence
from struct import pack

#: White space as the tokenizers' patterns know it; Python's \\s also has \\x1c-\\x1f.
_SPACE, _SOLID = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
#: Letters that stay one letter in lower case (so not U+0130).
_LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
_MARK = "[.,;:!?#$%&*]"
_CHUNK = re.compile(rf" ?[{_LATIN}]+(?=[ \n]|{_MARK}|\Z)|{_MARK}+(?=[ \n]|\Z)|\n(?=[{_LATIN}])|{_SPACE}*{_SOLID}+|{_SPACE}+")
_WORD = re.compile(rf" ?[{_LATIN}]+")
#: Plain text has none of these: lower case goes letter by letter, and \s is white space.
_OTHER = re.compile("[^\x00-\x1b\x20-\u012f\u0131-\u024f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]")
_PLAIN = re.compile(rf"[{_LATIN}]+(?=\s|{_MARK}|\Z)|{_MARK}+(?=\s|\Z)|\S+")
CACHED_CHUNKS = 250_000
#: Longer chunks are encoded but not kept, which bounds the cache's bytes.
CACHED_LENGTH = 64
END_ID = 1


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files are; every executor has them installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder(dict):
    """Ids of texts as little-endian 32-bit bytes, equal to the library's for the whole text.

    Both vocabularies split text before their merges. No such piece runs from a character
    that is not white space into white space, nor from a letter into one of ``.,;:!?#$%&*``, nor from a
    single line feed into a letter: cutting there changes no id, and the same chunk has the same ids
    everywhere. The dictionary is the cache, chunk -> ids; once full it becomes the old one, from which
    chunks that are met again move on.

    A text that names a special token, in any case of letters, goes to the library whole. There the name is that
    token, as in a plain call of the library; with ``ordinary`` it is text like any other.
    """

    def __init__(self, path: str, cached: int = CACHED_CHUNKS, ordinary: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = ordinary
        names = [] if ordinary else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        #: every name has one of the heads
        self.heads = tuple({name[:2] for name in names})
        self.named = re.compile("|".join(map(re.escape, names)) or r"(?!)", re.I)
        self.model = self.tokenizer.model
        one, other = (self.tokenizer.encode(x, add_special_tokens=False).ids for x in ("Word", " word"))
        #: the vocabulary knows neither case nor white space
        self.folds = one == other
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        #: how the models write the bytes of a space, of Latin letters, and of their lower case, which may lie beyond them
        letters = {x for c in range(32, 0x250) for x in chr(c) + chr(c).lower()}
        self.written = {ord(x): level.pre_tokenize_str(x)[0][0] for x in letters}
        self.cached = cached
        self.old: dict[str, bytes] = {}

    def __missing__(self, chunk: str) -> bytes:
        """Ids of a chunk that is not in the cache. A word is one piece of the split, so the model takes it as it is."""
        ids = self.old.get(chunk)
        if ids is None:
            if _WORD.fullmatch(chunk):
                word = chunk.strip(" ").lower() if self.folds else chunk
                found = [t.id for t in self.model.tokenize(word.translate(self.written))]
            else:
                found = self.tokenizer.encode(chunk, add_special_tokens=False).ids
            ids = pack(f"<{len(found)}I", *found)
        if len(chunk) <= CACHED_LENGTH:
            self[chunk] = ids
        return ids

    def _chunks(self, text: str) -> list[str]:
        """The text in chunks; where the vocabulary folds, plain text in lower case and without white space."""
        if self.folds and not _OTHER.search(text):
            return _PLAIN.findall(text.lower())
        return _CHUNK.findall(text)

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        if len(self) > self.cached:
            self.old = dict(self)
            self.clear()
        return [self._one(text or "") for text in texts]

    def _one(self, text: str) -> bytes:
        if any(head in text for head in self.heads) and self.named.search(text):
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
            return pack(f"<{len(found)}I", *found)
        return b"".join(map(self.__getitem__, self._chunks(text)))


_encoders: dict[str, Encoder] = {}


def encoder(path: str, cached: int = CACHED_CHUNKS) -> Encoder:
    """One encoder for each vocabulary and Python worker, so that tasks share its cache; the last caller's bound holds."""
    if path not in _encoders:
        _encoders[path] = Encoder(path, cached)
    _encoders[path].cached = cached
    return _encoders[path]


def groups(texts: Sequence[str | None], limit: int = 1 << 18):
    """Ranges of texts of about ``limit`` characters together."""
    begin = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text or "") > limit:
            yield begin, i
            begin, size = i, 0
        size += len(text or "") + 1
    if begin < len(texts):
        yield begin, len(texts)
