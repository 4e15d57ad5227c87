"""Block algebra: dense n-d arrays are cut, moved and joined as arrays.

IDs: S8, S9, S10, S11, S18, A10, U4, W7.

A block is one row ``(keys..., origin, shape, values)``: ``origin`` and
``shape`` have one entry per axis, outermost first, and ``values`` is row-major.
The operators here shuffle blocks or pieces of blocks, never cells: a chunk
that is already where it belongs is not opened, one that straddles a border is
sliced along the axes it straddles, and a target is put together from the few
pieces that meet in it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcat.functions.arrays import let
from gridcat.operators.cells import clean_value
from gridcat.session import stored


def _product(shape: Column, start: int, end: int) -> Column:
    """Number of cells over axes ``start..end-1`` of an array column."""
    out = F.lit(1)
    for i in range(start, end):
        out = out * F.get(shape, F.lit(i))
    return out


def _ints(*items) -> Column:
    return F.array(*(F.lit(i).cast("int") if isinstance(i, int) else i.cast("int") for i in items))


# ---------------------------------------------------------------- S8
def array_to_blocks(arrays: DataFrame, values: str = "values", shape: str | Sequence[int] = "shape",
                    keep: Sequence[str] = (), origin: Sequence | None = None, axes: int | None = None) -> DataFrame:
    """Each row-major n-d array as one block.  ``shape`` is an array column
    (then ``axes`` says how many) or fixed sizes; ``origin`` gives the block's place per
    axis (columns or ints, 0 by default), such as a time step and a level.
    A NULL array gives no block, NaN becomes NULL, and an array that does not have as many
    values as its shape says fails the job."""
    n = axes if isinstance(shape, str) else len(shape)
    if n is None:
        raise ValueError("axes: the number of entries of the shape column")
    sizes = F.transform(F.col(shape), lambda s: s.cast("int")) if isinstance(shape, str) else _ints(*shape)
    at = [F.lit(0)] * n if origin is None else [F.lit(o) if isinstance(o, int) else F.col(o) if isinstance(o, str) else o
                                                for o in origin]
    cells = _product(F.col("shape"), 0, n)
    # a filter on the values may be moved in front of this, so NULL passes
    right = F.when(F.col("values").isNull() | (F.size("shape") == n) & (F.size("values") == cells), F.col("values")).otherwise(
        F.raise_error(F.lit("an array does not have the values its shape says")).cast("array<double>"))
    return (arrays.where(F.col(values).isNotNull())
            .select(*keep, _ints(*at).alias("origin"), sizes.alias("shape"),
                    F.transform(values, lambda v: clean_value(v)).alias("values"))
            .withColumn("values", right))


def blocks_to_cells(blocks: DataFrame, keys: Sequence[str], axes: Sequence[str], absent: bool = False) -> DataFrame:
    """``(keys..., axes..., value)``, one column per axis in the order given
    (as named by the file's ``dims``).  Cells without a value are left out unless ``absent``."""
    n = len(axes)
    ex = blocks.select(*keys, "origin", "shape", F.posexplode("values").alias("_p", "value"))
    if not absent:
        ex = ex.where(F.col("value").isNotNull())
    places = [(F.get("origin", F.lit(i)) + F.floor(F.col("_p") / _product(F.col("shape"), i + 1, n))
               % F.get("shape", F.lit(i))).cast("int").alias(a) for i, a in enumerate(axes)]
    return ex.select(*keys, *places, "value")


# ---------------------------------------------------------------- S9 / S18
def _sliced(axis: int) -> Column:
    """The part of ``values`` along one axis that a tile takes: one slice per outer index.  Its bounds
    are columns of their own (see ``cut``): inside a lambda a name also means a new column
    of the same select."""
    if axis == 0:
        return F.slice("values", F.col("_skip") + 1, F.col("_take"))
    return let(F.col("values"), lambda v: F.flatten(F.transform(
        F.sequence(F.lit(0), F.col("_outer") - 1),
        lambda o: F.slice(v, o * F.col("_step") + F.col("_skip") + 1, F.col("_take")))))


def _replaced(array: str, at: int, axes: int, item: Column) -> Column:
    return _ints(*(item if i == at else F.get(array, F.lit(i)) for i in range(axes)))


def cut(blocks: DataFrame, keys: Sequence[str], sizes: Sequence[int]) -> DataFrame:
    """Blocks cut at the borders of a regular tiling with tiles of ``sizes``: rows
    ``(keys..., origin, shape, values)`` that each lie in one tile.  One axis after the other; a
    block is opened only along axes on which it crosses a border."""
    axes = len(sizes)
    out = blocks.select(*keys, "origin", "shape", "values")
    for axis, size in enumerate(sizes):
        start, length = F.get("origin", F.lit(axis)), F.get("shape", F.lit(axis))
        first, last = F.floor(start / size).cast("int"), F.floor((start + length - 1) / size).cast("int")
        dealt = out.select("*", F.explode(F.sequence(first, last)).alias("_tile"), (first == last).alias("_whole"))
        low = F.greatest(start, F.col("_tile") * size)
        high = F.least(start + length, (F.col("_tile") + 1) * size)
        inner, outer = _product(F.col("shape"), axis + 1, axes), _product(F.col("shape"), 0, axis)
        placed = dealt.withColumns({"_low": low, "_n": high - low, "_skip": (low - start) * inner, "_take": (high - low) * inner,
                                    "_step": length * inner, "_outer": outer})
        out = placed.select(
            *keys, _replaced("origin", axis, axes, F.col("_low")).alias("origin"),
            _replaced("shape", axis, axes, F.col("_n")).alias("shape"),
            F.when(F.col("_whole"), F.col("values")).otherwise(_sliced(axis)).alias("values"))
    return out


def _runs(axes: int, sizes: Sequence[int]) -> Column:
    """The contiguous runs of a piece as structs ``(loc, run)`` placed in its tile."""
    width = F.get("shape", F.lit(axes - 1))
    rows = _product(F.col("shape"), 0, axes - 1)

    def loc(row: Column) -> Column:
        place, below = F.get("_at", F.lit(axes - 1)), F.lit(1)
        stride = F.lit(sizes[-1])
        for i in range(axes - 2, -1, -1):
            n = F.get("shape", F.lit(i))
            place = place + (F.get("_at", F.lit(i)) + F.floor(row / below) % n) * stride
            below, stride = below * n, stride * F.lit(sizes[i])
        return place.cast("int")

    return let(F.col("values"), lambda v: F.transform(F.sequence(F.lit(0), rows - 1), lambda r: F.struct(
        loc(r).alias("loc"), F.slice(v, r * width + 1, width).alias("run"))))


def _joined(runs: Column, n) -> Column:
    """A dense array of ``n`` values (int or column) from runs in any order, NULL where there is none; runs that
    overlap fail the job."""
    def fill(s: Column) -> Column:
        def piece(x: Column, i: Column) -> Column:
            end = F.when(i == 0, F.lit(0)).otherwise(F.get(s, i - 1)["loc"] + F.size(F.get(s, i - 1)["run"]))
            gap = F.when(x["loc"] >= end, x["loc"] - end).otherwise(
                F.raise_error(F.lit("blocks overlap")).cast("int"))
            return F.concat(F.array_repeat(F.lit(None).cast("double"), gap), x["run"])

        last = F.get(s, F.size(s) - 1)
        return F.concat(F.flatten(F.transform(s, piece)),
                        F.array_repeat(F.lit(None).cast("double"), (F.lit(n) if isinstance(n, int) else n) - last["loc"] - F.size(last["run"])))

    return let(F.array_sort(runs), fill)


def assemble(pieces: DataFrame, keys: Sequence[str], sizes: Sequence[int]) -> DataFrame:
    """Tiles of ``sizes`` put together from pieces that each lie in one tile (see ``cut``).  A tile is
    always whole: cells that no piece has are NULL.  Pieces of one tile must not overlap.  What
    meets in a group are the pieces of one tile, at most its cells."""
    axes, n = len(sizes), 1
    for s in sizes:
        n *= s
    tile = _ints(*(F.floor(F.get("origin", F.lit(i)) / s) * s for i, s in enumerate(sizes)))
    placed = pieces.withColumn("_tile", tile).withColumn(
        "_at", _ints(*(F.get("origin", F.lit(i)) - F.get("_tile", F.lit(i)) for i in range(axes))))
    whole = F.col("shape") == _ints(*sizes)
    # a piece that fills its tile travels as it is, others as runs
    struct = F.when(whole, F.array(F.struct(F.lit(0).alias("loc"), F.col("values").alias("run")))).otherwise(
        _runs(axes, sizes))
    met = placed.select(*keys, "_tile", struct.alias("_runs")).groupBy(*keys, "_tile").agg(
        F.flatten(F.collect_list("_runs")).alias("_runs"))
    alone = (F.size("_runs") == 1) & (F.size(F.get("_runs", F.lit(0))["run"]) == n)
    return met.select(*keys, F.col("_tile").alias("origin"), _ints(*sizes).alias("shape"),
                      F.when(alone, F.get("_runs", F.lit(0))["run"]).otherwise(_joined(F.col("_runs"), n)).alias("values"))


def retile(blocks: DataFrame, keys: Sequence[str], sizes: Sequence[int]) -> DataFrame:
    """The same cells in blocks of ``sizes``, whatever the blocks' sizes were.  The shuffle
    carries pieces of blocks: ``prod(sizes)`` times fewer rows than cells where sizes are alike."""
    return assemble(cut(blocks, keys, sizes), keys, sizes)


# ---------------------------------------------------------------- S11 / U4 / W7
def time_offsets(lengths: DataFrame, manifest: DataFrame, keys: Sequence[str], store: str = "store") -> DataFrame:
    """``(store, keys..., steps, offset, end)``: the steps of all stores before in manifest
    order, and of all stores.  ``lengths`` is ``(store, keys..., steps)``, a row per store and key; a
    store that the manifest (``seq``, store) lacks fails the job."""
    from pyspark.sql import Window

    known = lengths.join(manifest.select("seq", store), store, "left").withColumn(
        "seq", F.when(F.col("seq").isNull(), F.raise_error(F.concat(
            F.lit("store not in the manifest: "), F.coalesce(F.col(store).cast("string"), F.lit("NULL")))).cast("bigint"))
        .otherwise(F.col("seq")))
    of_key = Window.partitionBy(*keys)      # a row per store
    before = of_key.orderBy("seq", store).rowsBetween(Window.unboundedPreceding, -1)
    return known.select(store, *keys, F.col("steps").cast("int").alias("steps"),
                        F.coalesce(F.sum("steps").over(before), F.lit(0)).cast("int").alias("offset"),
                        F.sum("steps").over(of_key).cast("int").alias("end"))


def append_stores(chunks: DataFrame, manifest: DataFrame, lengths: DataFrame, keys: Sequence[str], steps: int,
                  store: str = "store") -> DataFrame:
    """S11 + U4: chunk stores concatenated along time, the outermost axis, in manifest order:
    ``(keys..., origin, shape, values)`` with chunks of ``steps`` time steps, the last one shorter.

    ``chunks``: ``(store, keys..., origin, shape, values)`` with ``steps`` time steps each, times
    counted per store from 0; ``lengths``: see ``time_offsets`` (a store's last chunk may be
    short, or padded).  A chunk that comes to lie between two borders is only renamed: its
    array is not opened and not shuffled.  Others are sliced where a border crosses them, and
    their pieces, planes of whole time steps, meet by target chunk.  Where all stores are
    aligned there is no such branch at all.

    Every cell stays, shifted by its store's offset; times are not compared.
    """
    offsets = stored(time_offsets(lengths, manifest, keys, store), "time-offsets")
    rest = F.slice("shape", 2, F.size("shape") - 1)
    plane = F.aggregate(rest, F.lit(1), lambda a, b: a * b)
    filled = F.least(F.get("shape", F.lit(0)), F.col("steps") - F.get("origin", F.lit(0)))
    head = F.when(filled == F.get("shape", F.lit(0)), F.col("values")).otherwise(
        F.slice("values", F.lit(1), F.col("_n") * plane))      # without the padding after the store's last step
    placed = (chunks.join(offsets, [store, *keys])
              .withColumns({"_t": F.get("origin", F.lit(0)) + F.col("offset"), "_n": filled}).where("_n > 0")
              .select(*keys, "_t", "_n", F.col("end").alias("_end"), rest.alias("_rest"), plane.alias("_plane"),
                      F.slice("origin", 2, F.size("origin") - 1).alias("_place"), head.alias("values")))
    first, last = (F.floor(t / steps).cast("int") for t in (F.col("_t"), F.col("_t") + F.col("_n") - 1))
    # a chunk is at home if it starts at a border and fills its target, or ends where everything ends
    home = (F.col("_t") % steps == 0) & ((F.col("_n") == steps) | (F.col("_t") + F.col("_n") == F.col("_end")))
    at_home = placed.where(home).select(*keys, F.concat(_ints(F.col("_t")), "_place").alias("origin"),
                                        F.concat(_ints(F.col("_n")), "_rest").alias("shape"), "values")
    if offsets.where(F.col("offset") % steps != 0).isEmpty():
        return at_home
    moved = placed.where(~home).select("*", F.explode(F.sequence(first, last)).alias("_chunk"))
    low = F.greatest("_t", F.col("_chunk") * steps)
    high = F.least(F.col("_t") + F.col("_n"), (F.col("_chunk") + 1) * steps)
    piece = F.struct(((low - F.col("_chunk") * steps) * F.col("_plane")).cast("int").alias("loc"),
                     F.slice("values", ((low - F.col("_t")) * F.col("_plane") + 1).cast("int"),
                             ((high - low) * F.col("_plane")).cast("int")).alias("run"))
    # at most `steps` pieces meet in a chunk
    met = moved.groupBy(*keys, "_chunk", "_place", "_rest", "_plane", "_end").agg(F.collect_list(piece).alias("_pieces"))
    length = F.least(F.lit(steps), F.col("_end") - F.col("_chunk") * steps).cast("int")
    seam = met.select(*keys, F.concat(_ints(F.col("_chunk") * steps), "_place").alias("origin"),
                      F.concat(_ints(length), "_rest").alias("shape"),
                      _joined(F.col("_pieces"), (length * F.col("_plane")).cast("int")).alias("values"))
    return at_home.unionByName(seam)


# ---------------------------------------------------------------- A10
def overview_tiles(tiles: DataFrame, keys: Sequence[str], levels: Sequence[int], size: int) -> DataFrame:
    """A10: overviews of square 2-d tiles (``size``, even): each level's tile is put together
    from the 2 x 2 tiles below it, every one reduced to a quarter inside its own row.  Sums and
    counts travel on, so a mean is the exact average of the base cells under it.

    Returns ``(keys..., level, origin, shape, values, n)``: means (NULL where no base cell has a
    value) and counts.  A level is written to the shared folder, since the next reads it too."""
    if size % 2:
        raise ValueError("size must be even")
    half, n = size // 2, size * size
    below = tiles.select(*keys, "origin", "shape", F.transform("values", lambda v: F.coalesce(v, F.lit(0.0))).alias("total"),
                         F.transform("values", lambda v: F.when(v.isNull(), 0).otherwise(1).cast("bigint")).alias("n"))

    def quarter(values: Column) -> Column:
        def cell(v: Column, i: Column) -> Column:
            at = F.floor(i / half).cast("int") * (2 * size) + (i % half) * 2
            return F.get(v, at) + F.get(v, at + 1) + F.get(v, at + size) + F.get(v, at + size + 1)

        return let(values, lambda v: F.transform(F.sequence(F.lit(0), F.lit(half * half - 1)), lambda i: cell(v, i)))

    def side(k: str, zero: Column) -> Column:
        """The parent's array from its children's quarters, found by their place (0..3)."""
        def cell(found: Column, i: Column) -> Column:
            y, x = F.floor(i / size).cast("int"), i % size
            child = F.floor(y / half).cast("int") * 2 + F.floor(x / half).cast("int")
            return F.coalesce(F.get(F.get(found, child), (y % half) * half + x % half), zero)

        def by_place(places: Column) -> Column:
            return F.transform(F.sequence(F.lit(0), F.lit(3)), lambda p: F.get(F.filter(places, lambda c: c["at"] == p),
                                                                               F.lit(0))[k])

        return let(by_place(F.col("_children")), lambda found: F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                                                                           lambda i: cell(found, i)))

    out, at = None, 0
    for z in range(1, max(levels) + 1):
        ty, tx = (F.floor(F.get("origin", F.lit(i)) / size).cast("int") for i in (0, 1))
        child = F.struct((F.pmod(ty, F.lit(2)) * 2 + F.pmod(tx, F.lit(2))).alias("at"), quarter(F.col("total")).alias("total"),
                         quarter(F.col("n")).alias("n"))
        met = below.groupBy(*keys, F.floor(ty / 2).cast("int").alias("_ty"), F.floor(tx / 2).cast("int").alias("_tx")).agg(
            F.collect_list(child).alias("_children"))
        below = stored(met.select(*keys, _ints(F.col("_ty") * size, F.col("_tx") * size).alias("origin"),
                                  _ints(size, size).alias("shape"), side("total", F.lit(0.0)).alias("total"),
                                  side("n", F.lit(0).cast("bigint")).alias("n")), f"overview-tiles-{z}")
        at = z
        if z in levels:
            mean = F.zip_with("total", "n", lambda t, c: F.when(c > 0, t / c))
            level = below.select(*keys, F.lit(at).alias("level"), "origin", "shape", mean.alias("values"), "n")
            out = level if out is None else out.unionByName(level)
    return out
