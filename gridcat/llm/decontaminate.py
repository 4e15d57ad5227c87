"""Benchmark decontamination by pigeonhole edit matching.

A benchmark item that stands in a document with at most ``k`` edits has, cut
into ``k + 1`` pieces, one piece that stands there unchanged.  Each task finds
all exact piece hits in a text with one Aho-Corasick automaton, and verifies the
places they point to with Myers' bit-parallel edit distance.  Items are a
query set against all documents: they go out in blocks of bounded size, one pass over
the documents each, and documents are never shuffled.  Short items take part exactly,
as whole words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Texts

EDIT_SHARE = 0.05       # error budget: edits per character of an item
EXACT_BELOW = 24        # items shorter than this (normalised) have to stand in a text as they are, as whole words
BLOCK_BYTES = 4 << 20   # of item text that is sent to the tasks at a time

_WORD = re.compile(r"[^\W_]+")
_GAPS = re.compile(r"[\W_]+")


def normalised(text: str) -> str:
    """Lower case, words apart by one blank."""
    return _GAPS.sub(" ", text.lower()).strip()


@dataclass(frozen=True)
class Item:
    item_id: int
    pattern: str
    budget: int
    whole: bool = False     # only between word borders

    def pieces(self) -> Iterator[tuple[str, int]]:
        """The pattern cut into budget + 1 even pieces, with their places."""
        m, n = len(self.pattern), self.budget + 1
        for i in range(n):
            a, b = i * m // n, (i + 1) * m // n
            yield self.pattern[a:b], a


def prepared(rows: list, edit_share: float = EDIT_SHARE, exact_below: int = EXACT_BELOW) -> list[Item]:
    """Items with their error budgets.  One of fewer than ``exact_below`` characters has budget 0 and
    matches whole words only; one without any word has nothing to match."""
    items = []
    for item_id, text in rows:
        pattern = normalised(text or "")
        if pattern:
            short = len(pattern) < exact_below
            items.append(Item(item_id, pattern, 0 if short else int(len(pattern) * edit_share), short))
    return items


def myers(pattern: str, text: str, anchored: bool = False) -> list[int]:
    """Edit distance of ``pattern`` to the best piece of ``text`` that ends after each
    place 0..len(text); ``anchored`` pieces start at place 0."""
    m = len(pattern)
    places: dict[str, int] = {}
    for i, c in enumerate(pattern):
        places[c] = places.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, out = full, 0, m, [m]
    for c in text:
        eq = places.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        plus = down | ~(diagonal | up) & full
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        plus = (plus << 1 | anchored) & full
        minus = minus << 1 & full
        up = minus | ~(diagonal | plus) & full
        down = plus & diagonal
        out.append(score)
    return out


def best_match(item: Item, text: str, starts: list[int]) -> tuple[int, int, int] | None:
    """Least distance within budget and the span of the first such match, at
    places within the budget of ``starts``; None if there is none."""
    m, k, best = len(item.pattern), item.budget, None
    starts = sorted(set(starts))
    i = 0
    while i < len(starts):
        j = i
        while j + 1 < len(starts) and starts[j + 1] - starts[j] <= 2 * k + 1:
            j += 1
        low, high = max(0, starts[i] - k), min(len(text), starts[j] + m + 2 * k)
        scores = myers(item.pattern, text[low:high])
        least = min(scores)
        if least <= k and (best is None or least < best[0]):
            end = scores.index(least)
            back = myers(item.pattern[::-1], text[low:low + end][::-1], anchored=True)
            length = len(back) - 1 - back[::-1].index(least)
            best = (least, low + end - length, low + end)
        i = j + 1
    return best


class Matcher:
    """Finds the items of one block in texts."""

    def __init__(self, items: list[Item]):
        import ahocorasick

        self.items = items
        pieces: dict[str, list[tuple[int, int]]] = {}
        for n, item in enumerate(items):
            for piece, at in item.pieces():
                pieces.setdefault(piece, []).append((n, at))
        self.automaton = ahocorasick.Automaton()
        for piece, owners in pieces.items():
            self.automaton.add_word(piece, (len(piece), owners))
        if pieces:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """``(item_id, distance, start, end)`` of every item in ``text``; the
        span in code points of the text as it is."""
        if not text or not len(self.automaton):
            return []
        plain = normalised(text)
        starts: dict[int, list[int]] = {}
        words: dict[int, int] = {}      # short items: the first place between word borders
        for last, (length, owners) in self.automaton.iter(plain):
            start = last - length + 1
            alone = (not start or plain[start - 1] == " ") and (last + 1 == len(plain) or plain[last + 1] == " ")
            for n, at in owners:
                if not self.items[n].whole:
                    starts.setdefault(n, []).append(start - at)
                elif alone:
                    words.setdefault(n, start)
        found = []
        for n in sorted(starts.keys() | words.keys()):
            if n in words:
                match = (0, words[n], words[n] + len(self.items[n].pattern))
            else:
                match = best_match(self.items[n], plain, starts[n])
            if match:
                found.append((self.items[n].item_id, match[0], match[1], match[2]))
        if found:
            original = _original_places(text)
            found = [(i, d, original(a), original(b - 1) + 1 if b > a else original(a)) for i, d, a, b in found]
        return found


def _original_places(text: str):
    """From places of the normalised text to places of ``text`` (lower-casing
    that lengthens a character keeps its word's start)."""
    lowered = text.lower()
    words = list(_WORD.finditer(lowered))
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w[0]) + 1

    def place(p: int) -> int:
        from bisect import bisect_right

        n = max(0, bisect_right(starts, p) - 1)
        return min(words[n].start() + p - starts[n], len(text) - 1) if words else 0

    return place


def blocks(items: DataFrame, item_id: str = "item_id", text: str = "text",
           block_bytes: int = BLOCK_BYTES) -> Iterator[list]:
    """Rows ``(item_id, text)`` in blocks of about ``block_bytes``, dealt by hash; equal
    rows count once, null texts not at all."""
    rows = items.select(item_id, text).where(F.col(text).isNotNull()).distinct()
    total = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    n = max(1, -(-total // block_bytes))
    for i in range(n):
        yield [(r[0], r[1]) for r in rows.where(F.pmod(F.xxhash64(item_id, text), F.lit(n)) == i)
               .orderBy(item_id, text).collect()]


def matches(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_id: str = "item_id",
            item_text: str = "text", edit_share: float = EDIT_SHARE, exact_below: int = EXACT_BELOW) -> DataFrame:
    """``(key, item_id, distance, start, end)`` for every document and item that stands
    in it within its error budget: the least distance and its first place.

    Null, empty and unmatched texts give no row; repeated documents give theirs each.  No
    items, or none with a word, give an empty result.
    """
    kind, item_kind = (df.schema[c].dataType.simpleString() for df, c in ((docs, key), (items, item_id)))
    schema = f"`{key}` {kind}, `{item_id}` {item_kind}, distance int, start int, end int"

    def finder(block: list[Item]):
        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            matcher = Matcher(block)
            for batch in batches:
                rows, hits = [], []
                for at, t in enumerate(Texts(batch.column(1))):
                    for hit in matcher.find(t):
                        rows.append(at)
                        hits.append(hit)
                columns = list(zip(*hits)) or [[], [], [], []]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(columns[0], items_type),
                     *(pa.array(c, pa.int32()) for c in columns[1:])],
                    names=[key, item_id, "distance", "start", "end"])

        from pyspark.sql.pandas.types import to_arrow_type

        items_type = to_arrow_type(items.schema[item_id].dataType)
        return docs.select(key, text).mapInArrow(run, schema)

    found = None
    for rows in blocks(items, item_id, item_text):
        part = finder(prepared(rows, edit_share, exact_below))
        found = part if found is None else found.unionByName(part)
    return found


def clean(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
          edit_share: float = EDIT_SHARE, exact_below: int = EXACT_BELOW) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item within its error budget."""
    place = docs.columns.index(text)

    def keeper(block: list[Item]):
        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            matcher = Matcher(block)
            for batch in batches:
                yield batch.filter(pa.array([not matcher.find(t) for t in Texts(batch.column(place))], pa.bool_()))

        return run

    for rows in blocks(items, item_id, item_text):
        block = prepared(rows, edit_share, exact_below)
        if block:
            docs = docs.mapInArrow(keeper(block), docs.schema)
    return docs
