"""Token ids of whole texts with the ``tokenizers`` library, inside tasks.

The byte-level vocabularies never merge across a space that follows a
non-space character, so a text is the concatenation of its pieces cut before such spaces.
Each piece is encoded once per worker and kept in a bounded table; texts with other runs of white space or
with a special token in them are encoded whole.

A piece that is not in the table is mostly a known word in new company, or one new word.  If it holds only letters of
the Latin blocks, ASCII digits and marks, spaces and line ends, it is cut into the words of the byte-level pre-tokenizer, whose pattern is plain
there, and new words go to the library's model one by one.  All other pieces take the library's whole path.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np

# White space before a space: the only places where pieces cut before every space would differ from the whole text.
_IRREGULAR = re.compile(r"\s ")
_MARK = "\x00"
# The pattern of the byte-level pre-tokenizer for the plain characters; all others are left out of its matches.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_WORD = re.compile(f" ?[{_LETTERS}]+")
_WORDS = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[!-/:-@\[-`{{-~]+|[ \n]+(?![^ \n])|[ \n]+")
_PLAIN = [c for c in map(chr, range(0x250)) if _WORDS.fullmatch(c)]
#: Pieces kept per worker (about 200 bytes each).
TABLE_PIECES = 700_000


class _Table(dict):
    """Ids of pieces and words, each encoded when it is first asked for; at most ``limit`` are kept."""

    def __init__(self, tokenizer):
        super().__init__({"": b""})
        self.tokenizer, self.limit = tokenizer, TABLE_PIECES
        self.tokenize, self.letters = tokenizer.model.tokenize, self._spelling()

    def _spelling(self) -> dict[int, str] | None:
        """How the pre-tokenizer spells the plain characters; None unless it is the byte-level one with its pattern and nothing else changes a word."""
        from tokenizers import models, pre_tokenizers

        kind, model = self.tokenizer.pre_tokenizer, self.tokenizer.model
        if not (isinstance(kind, pre_tokenizers.ByteLevel) and kind.use_regex and not kind.add_prefix_space and self.tokenizer.normalizer is None):
            return None
        if not isinstance(model, models.BPE) or model.dropout:
            return None
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        return {ord(c): "".join(word for word, _ in spell(c)) for c in _PLAIN}

    def __missing__(self, piece: str) -> bytes:
        worth = True
        if self.letters is None:
            ids = self.whole(piece)
        elif _WORD.fullmatch(piece):
            ids = self.word(piece)
        elif len("".join(words := _WORDS.findall(piece))) < len(piece):
            ids = self.whole(piece)
        elif len(words) == 1:
            ids = self.word(piece)
        else:
            known = len(self)
            ids = b"".join([self[x] for x in words])
            worth = known == len(self)  # with new words in it, a piece hardly comes again
        if worth and len(self) < self.limit:
            self[piece] = ids
        return ids

    def word(self, word: str) -> bytes:
        ids = [t.id for t in self.tokenize(word.translate(self.letters))]
        return struct.pack(f"<{len(ids)}I", *ids)

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4").tobytes()


class Encoder:
    """Encodes lists of texts."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        self.specials = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.table = _Table(tokenizer)

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out, ids = [], self.table.__getitem__
        for text in texts:
            if _MARK in text or _IRREGULAR.search(text) or any(s in text for s in self.specials):
                out.append(self.table.whole(text))
            else:
                out.append(b"".join(map(ids, text.replace(" ", _MARK + " ").split(_MARK))))
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def release() -> None:
    """Forget the tables of pieces; operators that do not encode call this on workers that did."""
    _encoders.clear()


def encoded_batches(texts, path: str, end_id: int, max_chars: int = 1_000_000, table_pieces: int | None = None):
    """(first index, list of id bytes with the end id) for slices of an Arrow text column, about a MB each; the worker keeps ``table_pieces`` pieces."""
    end = np.array([end_id], dtype="<u4").tobytes()
    enc, start, size, some = encoder(path), 0, 0, []
    enc.table.limit = table_pieces or TABLE_PIECES
    for i in range(len(texts)):
        text = texts[i].as_py() or ""
        some.append(text)
        size += len(text)
        if size >= max_chars or len(some) >= 512:
            yield start, [x + end for x in enc.encode(some)]
            start, size, some = i + 1, 0, []
    if some:
        yield start, [x + end for x in enc.encode(some)]
