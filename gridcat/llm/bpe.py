"""Byte-level BPE through the tokenizers library, with reuse of repeated units.

A text is cut in front of every white-space run that follows a non-space
character.  The byte-level pre-tokenizer always breaks there: no token of its
pattern reaches over such a place, its only lookahead (``\\s+(?!\\S)``) never
starts before one, and a special token holds no white space.  So encoding the
units apart and joining the ids gives exactly the ids of the whole text, and a
unit seen before needs no second call of the library.

Where no white space stands before a blank, splitting at the blanks gives the
units, without the blank that each of them begins with.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np

# Python counts U+001C..U+001F as white space and the library does not; a text
# holding one goes to the library whole.
_ODD = "\x1c\x1d\x1e\x1f"
_UNIT = re.compile(r"\s*\S+|\s+")
# white space before a blank; without it every blank starts a unit, and blanks alone cut most of the text
_GAP = re.compile(r"\s ")
# texts that blanks alone do not cut, in the pattern language of Arrow: the two above, with Python's white space
_UNCUT = r"[\x1c-\x1f]|[\t-\r\x{85}\p{Z}] "
# punctuation: a token of its own between a letter and the end of a unit, unless a special token holds it
_STOPS = ".,;:!?*$&#%"
_LATIN_END = "\u0250"    # letters before this are letters in every Unicode version
_LONG_UNIT = 64
# the byte alphabet: printable bytes stand for themselves, the others follow from U+0100 on
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_LETTER = {b: chr(b) for b in _PLAIN} | {
    b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(_PLAIN))}
_ALPHABET = {b: ord(c) for b, c in _LETTER.items()}
_BLANK = _LETTER[32]


def odd(text: str) -> bool:
    """Whether white space is not certain in ``text``."""
    return any(c in text for c in _ODD)


class _Units(dict):
    """Unit without its ``lead`` -> packed ids; a missing unit is encoded.  Two
    generations of at most ``limit`` units each: a full one becomes the elder, whose
    units come back when met again, so memory is bounded and frequent units stay."""

    def __init__(self, tokenizer, code: str, limit: int, lead: str = "", plain: _Units | None = None):
        super().__init__()
        self.tokenizer, self.model, self.code, self.limit = tokenizer, tokenizer.model, code, limit
        self.lead, self.plain = lead, self if plain is None else plain
        self.tokenize, self.mark = self.model.tokenize, _BLANK if lead else ""
        special = "".join(t.content for t in tokenizer.get_added_tokens_decoder().values())
        self.stops = "".join(c for c in _STOPS if c not in special)
        self.elder: dict[str, bytes] = {}

    def __missing__(self, unit: str) -> bytes:
        if len(unit) > _LONG_UNIT:
            return self._encoded(self.lead + unit)
        packed = self.elder.get(unit)
        if packed is None:
            if unit.isascii() and unit.isalpha():       # most units: one token of the pre-tokenizer
                packed = array(self.code, [t.id for t in self.tokenize(self.mark + unit)]).tobytes()
            elif (core := unit.rstrip(self.stops)) != unit and core[-1:].isalpha() and core[-1] < _LATIN_END:
                packed = self[core] + self.plain[unit[len(core):]]
            elif not self.lead and unit[:1] == "\n" and unit[1:2].isascii() and unit[1:2].isalpha():
                packed = self["\n"] + self[unit[1:]]       # a line break before a letter is a token of its own
            elif self.lead and (at := unit.find("\n")) > 0:      # the end of a line and the start of another
                return self[unit[:at]] + b"".join(map(self.plain.__getitem__, _UNIT.findall(unit[at:])))
            else:
                packed = self._encoded(self.lead + unit)
        self.keep(unit, packed)
        return packed

    def keep(self, unit: str, packed: bytes) -> None:
        if len(self) >= self.limit:
            self.elder = dict(self)
            self.clear()
        self[unit] = packed

    def forget(self) -> None:
        self.clear()
        self.elder.clear()

    def _encoded(self, unit: str) -> bytes:
        # a word of letters, with or without a blank, is one token of the
        # pre-tokenizer, so the model's merges alone decide
        word = unit[1:] if unit[0] == " " else unit
        if word.isalpha() and (word.isascii() or max(word) < _LATIN_END):
            tokens = self.tokenize(_BLANK + word if word.isascii() and word is not unit
                                         else unit.encode().decode("latin-1").translate(_ALPHABET))
            return array(self.code, [t.id for t in tokens]).tobytes()
        return array(self.code, self.tokenizer.encode(unit, add_special_tokens=False).ids).tobytes()


class Bpe:
    """Encoder and decoder of one vocabulary file.  Ids travel packed as
    little-endian unsigned integers, two bytes each when the vocabulary fits."""

    def __init__(self, path: str, cached_units: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = "<u2" if self.size <= 1 << 16 else "<u4"
        self.width = int(self.dtype[-1])
        if sys.byteorder != "little":
            raise RuntimeError("packed ids are little-endian")
        code = "H" if self.width == 2 else "I"
        self.units = _Units(self.tokenizer, code, cached_units)
        self.spaced = _Units(self.tokenizer, code, cached_units, " ", self.units)     # units that follow a blank
        self._pieces: list[bytes] | None = None

    def encode(self, text: str) -> bytes:
        """Packed ids of ``text``, as ``encode(text, add_special_tokens=False)`` gives them."""
        if not text:
            return b""
        if odd(text):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
        if _GAP.search(text):
            return b"".join(map(self.units.__getitem__, _UNIT.findall(text)))
        first, *parts = text.split(" ")
        return b"".join([*map(self.units.__getitem__, _UNIT.findall(first)), *map(self.spaced.__getitem__, parts)])

    def encode_column(self, column, tail: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts of an Arrow column (no nulls) one after the other, packed ids ``tail`` after each, and
        the number of each text's ids, its tail's among them.

        What ``encode`` gives text by text, but Arrow cuts at the blanks and tells the units apart, so that
        a unit is looked up once a column and its ids are placed by number."""
        import pyarrow.compute as pc

        cut = ~pc.match_substring_regex(column, _UNCUT).to_numpy(zero_copy_only=False)
        whole = [self.encode(t.as_py()) for t in column.filter(~cut)]
        words = pc.split_pattern(column.filter(cut), " ")
        n_words = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        words = pc.list_flatten(words)
        first = np.zeros(len(words), bool)
        first[np.cumsum(n_words) - n_words] = True
        spaced = words.filter(~first).dictionary_encode()
        # pieces: a unit after a blank, what stands before a text's first blank, a text encoded whole, the tail
        packed = list(map(self.spaced.__getitem__, spaced.dictionary.to_numpy(zero_copy_only=False).tolist()))
        n_spaced = len(packed)
        packed += [b"".join(map(self.units.__getitem__, _UNIT.findall(t))) for t in words.filter(first).to_pylist()]
        packed += [*whole, tail]
        piece = np.empty(len(words), np.int64)
        piece[first] = n_spaced + np.arange(len(n_words))
        piece[~first] = spaced.indices.to_numpy(zero_copy_only=False)
        in_text = np.ones(len(column), np.int64)
        in_text[cut] = n_words
        ends = np.cumsum(in_text + 1)
        order = np.empty(ends[-1] if len(ends) else 0, np.int64)
        words_at = np.repeat(cut, in_text + 1)
        words_at[ends - 1] = False
        order[words_at] = piece
        order[(ends - 2)[~cut]] = n_spaced + len(n_words) + np.arange(len(whole))
        order[ends - 1] = len(packed) - 1

        flat = self.ids(b"".join(packed))
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // self.width
        starts, lengths = (np.cumsum(sizes) - sizes)[order], sizes[order]
        upto = np.cumsum(lengths)
        at = np.repeat(starts - (upto - lengths), lengths)
        at += np.arange(len(at))
        return flat[at], np.diff(upto[ends - 1], prepend=0)

    def forget(self) -> None:
        """Drop the units met so far; the vocabulary stays."""
        self.units.forget()
        self.spaced.forget()

    def ids(self, packed: bytes) -> np.ndarray:
        return np.frombuffer(packed, self.dtype)

    @property
    def pieces(self) -> list[bytes]:
        """Bytes of each id, from the vocabulary's byte alphabet."""
        if self._pieces is None:
            byte_of = {c: b for b, c in _LETTER.items()}
            special = {i: t.content.encode() for i, t in self.tokenizer.get_added_tokens_decoder().items()}
            self._pieces = [special[i] if i in special else bytes(byte_of[c] for c in self.tokenizer.id_to_token(i))
                            for i in range(self.size)]
        return self._pieces

    def decode(self, packed: bytes) -> str:
        """Text of packed ids, special tokens included; bytes that are no
        UTF-8 become U+FFFD as in the library's decoder."""
        pieces = self.pieces
        return b"".join([pieces[i] for i in self.ids(packed).tolist()]).decode("utf-8", "replace")


SLICE_BYTES = 8 << 20     # of text that is encoded as one column


def text_slices(column, slice_bytes: int = SLICE_BYTES) -> Iterator:
    """Consecutive slices of an Arrow column of texts, of about ``slice_bytes`` or a longer text each."""
    import pyarrow.compute as pc

    number = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False).astype(np.int64)) // slice_bytes
    edges = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(column)]
    for low, high in zip(edges, edges[1:]):
        if high > low:
            yield column.slice(low, high - low)


CACHED_UNITS = 500_000     # of each generation
_LOADED: dict[tuple[str, int], Bpe] = {}


def load(path: str, cached_units: int = CACHED_UNITS) -> Bpe:
    """The worker's encoder of ``path``; reused by the tasks that follow."""
    if (path, cached_units) not in _LOADED:
        _LOADED[path, cached_units] = Bpe(path, cached_units)
    return _LOADED[path, cached_units]
