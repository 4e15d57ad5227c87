"""N-gram Jaccard join by universe partition.

The universe of shingles is cut by hash into segments, whose number depends on a
set's size band.  Two sets that differ in at most H shingles, spread over
segments with allowances v, agree in some segment up to its allowance as soon as
the allowances sum to more than H: allowance 1 asks for equal subsets, 0 asks for
nothing.

Allowances are allotted by cost.  Every set first indexes all its segments'
subsets.  In a few rounds each set is linked to the leader with which it shares most entries, a
pair a set.  What that connects needs no further look, so the cost of an index entry is its number of
pairs across components; cheap entries (a bounded mean per row) are paired, dear ones
get allowance 0.  A set whose cheap segments still sum to more than H has met all
its partners.  The few others can only be linked with each other: they share their rarest
shingles, so each indexes as many of these as linked sets may differ in on one side
(prefix filter), rarity being read from a table of counters of fixed size.  Pairs leave an entry only
if the sketches, which the rows bring along, leave room for a link.  Every candidate is verified on
the whole sets.

Of equal sets one takes part.  A set's size picks its own band's scheme, and also the
next smaller band's if a partner can be in it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Texts, stored
from .components import components

WORDS = 5
SHARE = 80              # percent: linked where 100 * intersection >= SHARE * union
BAND_RATIO = 175        # percent: largest size of a band to its smallest
SPARE = 10              # percent of segments beyond those the pigeonhole needs
LEADER_ROUNDS = 3       # rounds that link every set to a leader of its entries, before pairs are priced
MEAN_PAIRS = 32         # pairs a row of an index entry that is paired, on average
BROADCAST_BYTES = 8 << 20
DIRECT_BYTES = 64 << 20     # of sets that are sent for pairs without asking first which pairs matter
_SKETCH_BITS = 512
_COUNTERS = 1 << 20     # counters of shingles, by low bits: a fixed size, as any order of shingles is right
_COUNTER_PARTS = 16
_BLOCK_ROWS = 1 << 20   # signatures that a task groups at a time
_BLOCK_SHINGLES = 1 << 16
SEARCH_ROWS = 1 << 20     # signatures that a task searches, about
_SEEN = 200_000         # sets that a task remembers, so that most copies are left out before the shuffle
_CHUNK = 1 << 16

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(13).integers(1, 1 << 64, 256, dtype=np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(out)


_POWERS, _BACK = _powers(_BASE, _CHUNK), _powers(_INVERSE, _CHUNK)
_FAR, _FAR_BACK = (np.uint64(pow(int(b), _CHUNK, 1 << 64)) for b in (_BASE, _INVERSE))


def _mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = x + np.uint64(salt * 0xD1342543DE82EF95 & (1 << 64) - 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of ``text``: A-Z lower-cased, words cut at
    ASCII white space, runs of ``words`` of them; fewer words are one shingle, none give none."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    data = b" ".join(parts)
    raw = np.frombuffer(data, np.uint8)
    ends = np.append(np.flatnonzero(raw == 32), len(raw))
    # prefix sums of the bytes' polynomial at each word's start and end; a shingle is the
    # difference of two, moved back to place 0
    at_end = np.empty(len(ends), np.uint64)
    n_chunks = (len(raw) - 1) // _CHUNK + 1
    with np.errstate(over="ignore"):
        far, far_back = (_powers(f, n_chunks + 1) for f in (_FAR, _FAR_BACK))
        if n_chunks == 1:
            at_end = np.cumsum(_BYTES[raw] * _POWERS[:len(raw)], dtype=np.uint64)[ends - 1]
        total, done = np.uint64(0), 0
        for chunk in range(n_chunks if n_chunks > 1 else 0):
            part = raw[chunk * _CHUNK:(chunk + 1) * _CHUNK]
            sums = np.cumsum(_BYTES[part] * _POWERS[:len(part)], dtype=np.uint64) * far[chunk] + total
            upto = np.searchsorted(ends, chunk * _CHUNK + len(part), "right")
            at_end[done:upto] = sums[ends[done:upto] - chunk * _CHUNK - 1]
            total, done = sums[-1], upto
        if len(parts) < words:
            return _mixed(at_end[-1:])
        starts = np.concatenate([[0], ends[:-1] + 1])
        gap, n = ends[:-1], len(parts) - words + 1
        if n_chunks == 1:
            power, back = _POWERS[gap], _BACK[starts[:n]]
        else:
            power = _POWERS[gap % _CHUNK] * far[gap // _CHUNK]
            back = _BACK[starts[:n] % _CHUNK] * far_back[starts[:n] // _CHUNK]
        at_start = np.concatenate([np.zeros(1, np.uint64), at_end[:-1] + _BYTES[32] * power])
        found = _mixed((at_end[words - 1:] - at_start[:n]) * back)
        found.sort()
        return found[np.concatenate([[True], found[1:] != found[:-1]])]


class Scheme:
    """Bands of sizes, and the segments of each band's partition of the universe."""

    def __init__(self, share: int = SHARE, largest: int = 1 << 40):
        self.share, self.low = share, [1]
        while self.low[-1] <= largest:
            self.low.append(max(self.low[-1], self.low[-1] * BAND_RATIO // 100, self.low[-1] * 100 // share) + 1)

    def band(self, n: int) -> int:
        return int(np.searchsorted(self.low, n, "right")) - 1

    def differences(self, total: int) -> int:
        """Most shingles that linked sets of ``total`` shingles together differ in."""
        return total * (100 - self.share) // (100 + self.share)

    def segments(self, band: int) -> int:
        high = self.low[band + 1] - 1
        most = self.differences(high + high * 100 // self.share)
        return most + 1 + most * SPARE // 100 + 1

    def roles(self, n: int) -> list[tuple[int, int, int]]:
        """``(band, segments, sum of allowances that a set of n shingles needs)``, own band first."""
        own = self.band(n)
        out = [(own, self.segments(own), self.differences(n + n * 100 // self.share) + 1)]
        below = self.low[own] - 1
        if below and below * 100 >= self.share * n:
            out.append((own - 1, self.segments(own - 1), self.differences(n + below) + 1))
        return out


def _salts(band: int, places: np.ndarray) -> np.ndarray:
    return _mixed(places.astype(np.uint64) + np.uint64(band << 40), 2)


def subsets(found: np.ndarray, band: int, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of the segments that hold shingles, their places, and where each begins in ``found``."""
    place = ((found >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)     # ascends with the shingles
    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    with np.errstate(over="ignore"):
        body = np.add.reduceat(_mixed(found, 1), starts)
        return _mixed(body + _salts(band, place[starts])), place[starts].astype(np.int64), starts


def subsets_of(sets: list[np.ndarray], scheme: Scheme) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of the segments that hold shingles, for all roles of several sets, and
    the place of each one's set among them."""
    roles = [(i, band, segments) for i, found in enumerate(sets) for band, segments, _ in scheme.roles(len(found))]
    owner, band, segments = (np.array(c, np.int64) for c in zip(*roles))
    found = np.concatenate([sets[i] for i, _, _ in roles])
    role = np.repeat(np.arange(len(roles)), [len(sets[i]) for i, _, _ in roles])
    place = ((found >> np.uint64(32)) * segments.astype(np.uint64)[role]) >> np.uint64(32)
    heads = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (role[1:] != role[:-1])]))
    of = role[heads]
    with np.errstate(over="ignore"):
        body = np.add.reduceat(_mixed(found, 1), heads)
        salts = _mixed(place[heads] + (band.astype(np.uint64) << np.uint64(40))[of], 2)
        return _mixed(body + salts), owner[of]


def segments_held(found: np.ndarray, segments: int) -> int:
    """Number of segments that hold shingles."""
    place = ((found >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)
    return 1 + int(np.count_nonzero(place[1:] != place[:-1]))


def neighbourhoods(found: np.ndarray, band: int, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of all segments' subsets, empty ones included, and of these after one deletion: with the
    segments' places and whether one was deleted."""
    _, held, starts = subsets(found, band, segments)
    own = _mixed(found, 1)
    sizes = np.diff(np.append(starts, len(found)))
    with np.errstate(over="ignore"):
        body = np.zeros(segments, np.uint64)
        body[held] = np.add.reduceat(own, starts)
        of = np.repeat(held, sizes)
        salts = _salts(band, np.arange(segments))
        full, less = _mixed(body + salts), _mixed(body[of] - own + salts[of])
    return (np.concatenate([full, less]), np.concatenate([np.arange(segments), of]),
            np.concatenate([np.zeros(segments, bool), np.ones(len(of), bool)]))


def sketch(found: np.ndarray) -> np.ndarray:
    """Parities of the shingles by low bits: sets differ in at least as many shingles as sketches in bits."""
    odd = np.bincount((found & np.uint64(_SKETCH_BITS - 1)).astype(np.int64), minlength=_SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch(found: np.ndarray) -> bytes:
    """``sketch`` with at least two bits a shingle, a power of two of them."""
    bits = max(_SKETCH_BITS, 1 << (2 * len(found) - 1).bit_length())
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def least_differences(a: bytes, b: bytes) -> int:
    """Shingles that two sets differ in at least, by their wide sketches; the longer is folded."""
    x, y = (np.frombuffer(v, np.uint8) for v in (a, b))
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def _name(found: np.ndarray) -> bytes:
    return hashlib.blake2b(found.tobytes(), digest_size=16).digest()


def _start(name: bytes) -> int:
    return int.from_bytes(name[:8], "little", signed=True)


def marked(docs: DataFrame, key: str, text: str, words: int, share: int) -> DataFrame:
    """``(__key, n, s, s1, sketch, spare, place)`` per row: size and name of the set (null if empty), sketch, how
    many of its segments may be dear, and the row's place in ``docs``."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scheme = Scheme(share)
        for batch in batches:
            sizes, names, starts, sketches, spares = [], [], [], [], []
            for t in Texts(batch.column(1)):
                found = shingles(t, words)
                sizes.append(len(found))
                names.append(_name(found) if len(found) else None)
                starts.append(_start(names[-1]) if len(found) else None)
                sketches.append(sketch(found))
                spares.append(min(segments_held(found, m) - need for _, m, need in scheme.roles(len(found)))
                              if len(found) else 0)
            width = _SKETCH_BITS // 64
            flat = np.concatenate(sketches) if sketches else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), pa.array(starts, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, width, dtype=np.int32)), pa.array(flat)),
                 pa.array(spares, pa.int32()),
                 batch.column(2)], names=["__key", "n", "s", "s1", "sketch", "spare", "place"])

    return docs.select(key, text, F.monotonically_increasing_id()).mapInArrow(
        run, f"__key {kind}, n bigint, s binary, s1 bigint, sketch array<bigint>, spare int, place bigint")


def shared_subsets(docs: DataFrame, text: str, words: int, share: int, partitions: int) -> DataFrame:
    """``(sig, s1)`` of all segment subsets that two or more different sets have; ``s1`` is the
    first half of a set's name.  Only linked sets alike in it could be missed, at odds of 2 ** -64 a
    pair; sets alike in it by chance only add candidates.

    A task groups the signatures of a block of texts itself; of those that it meets twice it
    sends one into the search, so a signature brings there at most a row a block however many
    sets have it, and the search's ``partitions`` are even: a task sorts its share as two arrays.
    """

    def emit(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scheme, seen = Scheme(share), set()
        sigs, names, held = [], [], 0
        sets, owners, shingles_held = [], [], 0

        def flushed():
            # rows stay in the order of the sets, which repeats names side by side in the shuffle files
            sig, name = np.concatenate(sigs), np.concatenate(names)
            order = np.argsort(sig, kind="stable")
            again = np.zeros(len(sig), bool)
            again[1:] = sig[order[1:]] == sig[order[:-1]]
            twice = again.copy()
            twice[:-1] |= again[1:]
            met = np.empty(len(sig), np.int8)
            met[order] = twice.astype(np.int8) + again
            return pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(name), pa.array(met)],
                                              names=["sig", "s1", "met"])

        def indexed():
            sig, owner = subsets_of(sets, scheme)
            sigs.append(sig)
            names.append(np.array(owners, np.int64)[owner])
            return len(sig)

        for batch in batches:
            for t in Texts(batch.column(0)):
                found = shingles(t, words)
                if not len(found):
                    continue
                name = _start(_name(found))
                if name in seen:
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(name)
                sets.append(found)
                owners.append(name)
                shingles_held += len(found)
                if shingles_held >= _BLOCK_SHINGLES:
                    held += indexed()
                    sets, owners, shingles_held = [], [], 0
                if held >= _BLOCK_ROWS:
                    yield flushed()
                    sigs, names, held = [], [], 0
        if sets:
            indexed()
        if sigs:
            yield flushed()

    def search(batches: Iterator) -> Iterator:
        import pyarrow as pa

        parts = [[np.asarray(c) for c in batch.columns] for batch in batches if batch.num_rows]
        if not parts:
            return
        sig, name, met = (np.concatenate(c) for c in zip(*parts))
        del parts
        order = np.argsort(sig, kind="stable")
        same = sig[order[1:]] == sig[order[:-1]]
        several = np.zeros(len(sig), bool)
        several[order[1:]] |= same
        several[order[:-1]] |= same
        some = np.flatnonzero(several | (met > 0))
        sig, name, met = sig[some], name[some], met[some] > 0
        order = np.lexsort((name, sig))
        sig, name, met = sig[order], name[order], met[order]
        # rows of one set count once, as met if any was
        heads = np.flatnonzero(np.concatenate([[True], (sig[1:] != sig[:-1]) | (name[1:] != name[:-1])])[:len(sig)])
        if not len(heads):
            return
        met = np.logical_or.reduceat(met, heads)
        sig, name = sig[heads], name[heads]
        same = sig[1:] == sig[:-1]
        met[1:] |= same
        met[:-1] |= same
        yield answer(pa, sig[met], name[met])

    def answer(pa, sig, name):
        return pa.RecordBatch.from_arrays([pa.array(sig.astype(np.int64)), pa.array(name.astype(np.int64))], names=["sig", "s1"])

    rows = docs.select(text).mapInArrow(emit, "sig bigint, s1 bigint, met tinyint")
    # rows that a task knows to be met a second time are dealt by set and only pass through
    deal = F.when(F.col("met") == 2, F.xxhash64("s1", "sig")).otherwise(F.col("sig"))
    return rows.repartition(partitions, deal).mapInArrow(search, "sig bigint, s1 bigint")


def _near_sizes(a: str, b: str, share: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * share


def _sketches_near(share: int) -> Column:
    """Whether two sets' sketches (a_sketch, b_sketch) leave room for a link at their sizes."""
    differ = sum((F.bit_count(F.col("a_sketch")[i].bitwiseXOR(F.col("b_sketch")[i])) for i in range(_SKETCH_BITS // 64)), F.lit(0))
    return differ * (100 + share) <= (F.col("a_n") + F.col("b_n")) * (100 - share)


def _small(rows: DataFrame, row_bytes: int) -> DataFrame:
    """A stored table, marked for broadcast if its counted rows stay below the bound."""
    return F.broadcast(rows) if rows.count() * row_bytes <= BROADCAST_BYTES else rows


class Sets:
    """The distinct sets of a table of texts, and what verifies pairs of them."""

    def __init__(self, docs: DataFrame, key: str, text: str, words: int, share: int):
        self.docs, self.key, self.text, self.words, self.share = docs, key, text, words, share
        self.marks = stored(marked(docs, key, text, words, share), "sets")
        named = self.marks.where("s is not null").groupBy("s").agg(
            F.min("__key").alias("first"), F.min("place").alias("place"), F.first("s1").alias("s1"), F.first("n").alias("n"), F.first("sketch").alias("sketch"),
            F.first("spare").alias("spare"))
        self.classes = stored(named.withColumn("id", F.monotonically_increasing_id()), "set-classes")

    def shingles_of(self, ids: DataFrame) -> DataFrame:
        """``(id, shingles, wide)`` of the sets named by ``ids`` (column id, distinct), read from one
        text of each, found by its place in the table."""
        wanted = stored(ids.join(self.classes, "id").select("id", F.col("s").alias("__s"), F.col("place").alias("__at")), "wanted")
        wanted = _small(wanted, 48)
        words = self.words

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                found = [shingles(t, words) for t in Texts(batch.column(2))]
                if [_name(f) for f in found] != batch.column(1).to_pylist():
                    raise ValueError("the table's rows have changed their places: store it first")
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array([f.tobytes() for f in found], pa.binary()),
                     pa.array([wide_sketch(f) for f in found], pa.binary())], names=["id", "shingles", "wide"])

        rows = self.docs.select(F.monotonically_increasing_id().alias("__place"), F.col(self.text).alias("__t"))
        return stored(rows.join(wanted, F.col("__place") == F.col("__at")).select("id", "__s", "__t")
                      .mapInArrow(run, "id bigint, shingles binary, wide binary"), "shingles")

    def sketched(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the sketch of their ``id``."""
        return rows.join(self.classes.select("id", "sketch"), "id")

    def candidates(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` (a, b) whose sizes and sketches allow a link."""
        mine = self.classes.select("id", "n", "sketch")
        for side in "ab":
            pairs = pairs.join(mine.select(F.col("id").alias(side), F.col("n").alias(f"{side}_n"),
                                           F.col("sketch").alias(f"{side}_sketch")), side)
        return pairs.where(_near_sizes("a_n", "b_n", self.share) & _sketches_near(self.share)).select("a", "b")

    def measured(self, pairs: DataFrame, held: DataFrame) -> DataFrame:
        """The pairs that wide sketches leave room for a link, with the least number of shingles they
        differ in, ``d``, and their shingles in total, ``n``."""
        share = self.share
        for side in "ab":
            pairs = pairs.join(held.select(F.col("id").alias(side), F.col("wide").alias(f"{side}_wide"),
                                           (F.octet_length("shingles") / 8).cast("bigint").alias(f"{side}_n")), side)

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                apart = np.array([least_differences(x.as_py(), y.as_py()) for x, y in zip(batch.column(2), batch.column(3))],
                                 np.int64)
                total = np.asarray(batch.column(4))
                fits = pa.array(apart * (100 + share) <= total * (100 - share))
                yield pa.RecordBatch.from_arrays(
                    [c.filter(fits) for c in (batch.column(0), batch.column(1), pa.array(apart), batch.column(4))],
                    names=["a", "b", "d", "n"])

        laid = pairs.select("a", "b", "a_wide", "b_wide", (F.col("a_n") + F.col("b_n")).alias("n"))
        return stored(laid.mapInArrow(run, "a bigint, b bigint, d bigint, n bigint"), "measured")

    def verified(self, pairs: DataFrame, held: DataFrame) -> DataFrame:
        """The stored pairs ``(a, b)`` that are links, by their whole sets."""
        share = self.share
        ends = pairs.select("a", "b")
        few = ends.count() * 16 <= BROADCAST_BYTES
        pairs = F.broadcast(ends) if few else ends
        for side in "ab":
            of = held.select(F.col("id").alias(side), F.col("shingles").alias(f"{side}_set"))
            if few:         # sets that no pair asks for are not shuffled
                of = of.join(F.broadcast(ends.select(side).distinct()), side, "left_semi")
            pairs = pairs.join(of, side)

        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                fits = []
                for x, y in zip(batch.column(2), batch.column(3)):
                    x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                    both = len(x) + len(y)
                    merged = np.concatenate([x, y])
                    merged.sort()
                    common = int(np.count_nonzero(merged[1:] == merged[:-1]))
                    fits.append(100 * common >= share * (both - common))
                fits = pa.array(fits, pa.bool_())
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(fits) for i in (0, 1)], names=["a", "b"])

        return stored(pairs.select("a", "b", "a_set", "b_set").mapInArrow(run, "a bigint, b bigint"), "links")

    def linked(self, pairs: DataFrame, known: DataFrame | None = None, held: DataFrame | None = None,
               direct_bytes: int = DIRECT_BYTES) -> DataFrame:
        """Links among stored candidates ``(a, b)`` that connect all that their links connect.

        Many candidates lie between the same two components of the ``known`` links: of these the pair
        that differs least is verified first, and what it connects needs no other pair.  After
        two such rounds, or where the sets of all pairs are few bytes, the rest is verified whole."""
        if held is None:
            held = self.shingles_of(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id")))
                                    .distinct())
        pairs, found, rounds = self.measured(pairs, held), None, 0
        while known is not None and rounds < 2 and (pairs.agg(F.sum("n")).first()[0] or 0) * 8 > direct_bytes:
            apart = _apart(pairs, known if found is None else known.unionByName(found))
            nearest = apart.groupBy("low", "high").agg(F.min(F.struct("d", "a", "b")).alias("p")).select("p.a", "p.b")
            nearest = stored(nearest, "nearest")
            links = self.verified(nearest, held)
            found = links if found is None else found.unionByName(links)
            pairs = stored(apart.join(nearest, ["a", "b"], "left_anti").select("a", "b", "d", "n"), "open-pairs")
            rounds += 1
        if rounds:
            pairs = stored(_apart(pairs, known.unionByName(found)).select("a", "b"), "open-pairs")
        links = self.verified(pairs, held)
        return links if found is None else found.unionByName(links)


def _apart(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """The pairs that ``links`` do not connect, with their components as ``low`` and ``high``."""
    roots = stored(components(links), "roots")
    for side in "ab":
        pairs = pairs.join(roots.select(F.col("node").alias(side), F.col("root").alias(f"{side}_root")), side, "left")
    ends = [F.coalesce(f"{side}_root", side) for side in "ab"]
    return pairs.select("a", "b", "d", "n", F.least(*ends).alias("low"), F.greatest(*ends).alias("high")).where("low < high")


def _rooted(rows: DataFrame, links: DataFrame) -> DataFrame:
    """``rows`` with the component of their ``id`` by ``links`` as ``root``."""
    roots = stored(components(links), "roots")
    return rows.join(roots.withColumnRenamed("node", "id").withColumnRenamed("root", "__root"), "id", "left").select(
        *rows.columns, F.coalesce("__root", "id").alias("root"))


def _mixed_entries(rows: DataFrame) -> DataFrame:
    """Rows of index entries (sig, id, n, root) that pair different components, with ``main``, the
    entry's largest component, and ``across``, its pairs across components a row, each counted twice."""
    by_root = rows.groupBy("sig", "root").agg(F.count("*").alias("d"))
    entries = by_root.groupBy(F.col("sig").alias("__sig")).agg(
        F.sum("d").alias("d"), F.sum(F.col("d") * F.col("d")).alias("own"),
        F.count("*").alias("roots"), F.max(F.struct("d", "root"))["root"].alias("main"))
    entries = entries.where("roots > 1").select(
        "__sig", "main", (F.col("d") - F.col("own") / F.col("d")).alias("across"))
    return rows.join(entries, rows.sig == F.col("__sig")).drop("__sig")


def _priced(rows: DataFrame, mean_pairs: int) -> DataFrame:
    """``_mixed_entries`` with ``dear``, whether the entry's pairs exceed ``mean_pairs`` a row."""
    return _mixed_entries(rows).withColumn("dear", F.col("across") > 2 * mean_pairs)


def _across(rows: DataFrame, share: int) -> DataFrame:
    """Distinct pairs (a, b) of different components in one entry that sizes and sketches leave room for a
    link; the smaller set's row has to be a ``lead``.  One side is never of the entry's largest component, so its
    rows are not compared with each other."""
    minor = rows.where("root <> main").select("sig", *(F.col(c).alias(f"a_{c}") for c in ("id", "n", "root", "lead", "sketch")))
    other = rows.select("sig", "main", *(F.col(c).alias(f"b_{c}") for c in ("id", "n", "root", "lead", "sketch")))
    met = minor.join(other, "sig").where(
        (F.col("a_root") != F.col("b_root"))
        & ((F.col("b_root") == F.col("main")) | (F.col("a_id") < F.col("b_id")))
        & F.when(F.col("a_n") <= F.col("b_n"), F.col("a_lead")).otherwise(F.col("b_lead"))
        & _near_sizes("a_n", "b_n", share) & _sketches_near(share))
    return met.select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b")).distinct()


def _leaders(rows: DataFrame, tried: DataFrame | None) -> DataFrame:
    """A pair (a, b) per set b outside its entries' largest components: the leader (least id of such a
    component) with which it shares most entries, of those not yet ``tried``."""
    if tried is None:       # nothing is linked yet: every entry's least id leads
        entries = rows.groupBy("sig").agg(F.min("id").alias("lead")).withColumn("main", F.col("lead"))
    else:
        parts = rows.groupBy("sig", "root").agg(F.count("*").alias("d"), (-F.min("id")).alias("lead"))
        entries = parts.groupBy("sig").agg(F.max(F.struct("d", "lead", "root")).alias("m"), F.count("*").alias("roots")).where(
            "roots > 1").select("sig", (-F.col("m.lead")).alias("lead"), F.col("m.root").alias("main"))
    votes = rows.join(entries, "sig").where("root <> main").groupBy("id", "lead").agg(F.count("*").alias("votes"))
    if tried is not None:
        votes = votes.join(tried.select(F.col("a").alias("lead"), F.col("b").alias("id")), ["id", "lead"], "left_anti")
    best = votes.groupBy("id").agg(F.max(F.struct("votes", (-F.col("lead")).alias("lead")))["lead"].alias("lead"))
    return stored(best.select((-F.col("lead")).alias("a"), F.col("id").alias("b")), "leaders")


def _shingle_counts(held: DataFrame, counters: int) -> np.ndarray:
    """How many shingles of the sets ``held`` (id, shingles) have each value of their low bits."""
    width = counters // _COUNTER_PARTS

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total = np.zeros(counters, np.int64)
        for batch in batches:
            for raw in batch.column(0):
                found = np.frombuffer(raw.as_buffer(), np.uint64)
                np.add.at(total, (found & np.uint64(counters - 1)).astype(np.int64), 1)
        for part in range(_COUNTER_PARTS):
            at = np.flatnonzero(total[part * width:(part + 1) * width])
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([at.astype(np.int32).tobytes()], pa.binary()),
                     pa.array([total[part * width + at].tobytes()], pa.binary())], names=["part", "at", "n"])

    def merge(batches: Iterator) -> Iterator:
        import pyarrow as pa

        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, at, n in zip(*(c.to_pylist() for c in batch.columns)):
                sums.setdefault(part, np.zeros(width, np.int64))[np.frombuffer(at, np.int32)] += np.frombuffer(n, np.int64)
        for part, n in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n.tobytes()], pa.binary())],
                                             names=["part", "n"])

    parts = held.select("shingles").mapInArrow(count, "part int, at binary, n binary")
    total = np.zeros(counters, np.int64)
    for row in parts.repartition(_COUNTER_PARTS, "part").mapInArrow(merge, "part int, n binary").toLocalIterator():
        total[row.part * width:(row.part + 1) * width] = np.frombuffer(row.n, np.int64)
    return total


def prefix(found: np.ndarray, counts: np.ndarray, share: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a set, least counted first, of which each partner has one in its own prefix, and which
    of them are enough (lead) for partners of at least its size.  Shingles that no other set has are left out."""
    n = len(found)
    count = counts[(found & np.uint64(len(counts) - 1)).astype(np.int64)]
    order = np.lexsort((found, count))[:n - -(-share * n // 100) + 1]
    lead = np.arange(len(order)) < n - -(-2 * share * n // (100 + share)) + 1
    met = count[order] > 1
    return found[order][met], lead[met]


def _prefixes(held: DataFrame, share: int, counters: int = _COUNTERS) -> DataFrame:
    """``(id, sig, lead)``: the prefixes of the sets ``held`` (id, shingles), each set once."""
    counts = held.sparkSession.sparkContext.broadcast(_shingle_counts(held, counters))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids, sigs, leads = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, bool)]
            for owner, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                sig, lead = prefix(np.frombuffer(raw.as_buffer(), np.uint64), counts.value, share)
                ids.append(np.full(len(sig), owner, np.int64))
                sigs.append(sig)
                leads.append(lead)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(ids)), pa.array(np.concatenate(sigs).view(np.int64)), pa.array(np.concatenate(leads))],
                names=["id", "sig", "lead"])

    return held.select("id", "shingles").mapInArrow(run, "id bigint, sig bigint, lead boolean")


def links(sets: Sets, mean_pairs: int = MEAN_PAIRS, direct_bytes: int = DIRECT_BYTES) -> DataFrame:
    """Pairs (a, b) of set ids, each a verified link, that connect all linked sets: a pair is left
    out only if others of the result connect it already."""
    share = sets.share
    # about half as many signatures as shingles
    rows = sets.classes.agg(F.sum("n")).first()[0] or 0
    hits = stored(shared_subsets(sets.docs, sets.text, sets.words, share, max(1, rows // (2 * SEARCH_ROWS)))
                  .join(sets.classes.select("s1", "id", "n"), "s1").select("sig", "id", "n").distinct(), "entries")
    rows, tried, found = hits.withColumn("root", F.col("id")), None, None
    for _ in range(LEADER_ROUNDS):
        nearest = _leaders(rows, tried)
        new = sets.linked(stored(sets.candidates(nearest), "candidates"))
        found = new if found is None else found.unionByName(new)
        rows = stored(_rooted(hits, found), "rooted-entries")
        tried = nearest if tried is None else tried.unionByName(nearest)
        if new.isEmpty():
            break

    priced = stored(_priced(rows.withColumn("lead", F.lit(True)), mean_pairs), "priced")
    pairs = stored(_across(sets.sketched(priced.where("not dear")), share), "candidates")
    found = found.unionByName(sets.linked(pairs, found, direct_bytes=direct_bytes))

    # sets whose cheap segments do not reach the pigeonhole's sum
    dear = priced.where("dear").groupBy("id").agg(F.count("*").alias("dear"))
    short = sets.classes.join(dear, "id", "left").where(F.col("spare") < F.coalesce("dear", F.lit(0))).select("id")
    short = stored(short, "short")
    if short.isEmpty():
        return found
    held = sets.shingles_of(short)
    known = _rooted(short.join(sets.classes.select("id", "n"), "id"), found)
    rows = stored(_prefixes(held, share).join(known, "id"), "prefixes")
    pairs = stored(_across(sets.sketched(_mixed_entries(rows)), share), "candidates")
    return found.unionByName(sets.linked(pairs, found, held, direct_bytes))


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, share: int = SHARE,
           mean_pairs: int = MEAN_PAIRS, direct_bytes: int = DIRECT_BYTES) -> DataFrame:
    """``key, n_shingles, component`` for every row of ``docs``: the size of its set of distinct shingles
    and the least key reachable over links, its own included.

    Null, empty or blank texts have an empty set and are linked with nothing.  Equal sets are
    linked, so repeated rows share a component; a null key names one only if all keys of it
    are null.  ``mean_pairs`` sets where allowances fall and ``direct_bytes`` the order in which pairs are
    verified, never the result.  ``docs`` has to be a
    stored table: a set's text is read again by its row's place.
    """
    sets = Sets(docs, key, text, words, share)
    tied = stored(components(links(sets, mean_pairs, direct_bytes)), "set-components")
    rooted = sets.classes.join(tied, F.col("id") == F.col("node"), "left").select(
        "s", "first", F.coalesce("root", "id").alias("root"))
    rooted = stored(rooted, "rooted")
    names = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = rooted.join(names, "root").select("s", "component")
    some = sets.marks.where("s is not null").join(named, "s").select("__key", "n", "component")
    none = sets.marks.where("s is null").select("__key", "n", F.col("__key").alias("component"))
    return some.unionByName(none).select(F.col("__key").alias(key), F.col("n").alias("n_shingles"), "component")
