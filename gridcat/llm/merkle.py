"""Merkle manifest of a table with proofs found by pointer jumping.

Every row is a leaf; runs of three neighbours become their parent, per group
first and then over the groups' roots.  A node starts with the segment of its
own run: the siblings on the one step to its parent.  Each round joins the nodes
with themselves at the ancestor their segment ends at and appends that
ancestor's segment, so the distance doubles and a tree of height h takes about
log2(h) rounds until every leaf holds its whole path to the root.

Nodes are built in blocks of ``RUN ** BLOCK_LEVELS`` neighbours, a bounded number
of rows whatever the group's size, so a hot group is many blocks.  A key of the
joins has at most ``RUN ** distance`` rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

RUN = 3
BLOCK_LEVELS = 7
TOP = -1                    # the tree over the groups' roots
BROADCAST_BYTES = 8 << 20   # ancestors' segments that are sent to the tasks at most; joined by shuffle beyond
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_LEVEL_BITS = 56

_NODE = ("tree bigint, level int, idx bigint, width bigint, digest binary, seg binary, "
         "up_tree bigint, up_at bigint")


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 (binary) of fields told apart by their UTF-8 lengths; null is ``-``."""
    parts = []
    for field in fields:
        text = field.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.unhex(F.sha2(F.concat(*parts), 256))


def height(n: int) -> int:
    """Levels above the leaves of a tree of ``n`` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n // RUN), h + 1
    return h


def _parent(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def _step(run: list[str], at: int, seam: bool) -> bytes:
    """One step of a path: a byte (place in the run, number of siblings, whether the
    step is the first above the groups' roots) and the siblings' digests."""
    others = run[:at] + run[at + 1:]
    return bytes([at | len(others) << 2 | seam << 4]) + bytes.fromhex("".join(others))


def fold(digest: str, path: bytes) -> tuple[str, str]:
    """``(group's root, root)`` that a leaf's digest and its path lead to."""
    group, i = None, 0
    while i < len(path):
        head = path[i]
        at, n = head & 3, head >> 2 & 3
        if head & 16:
            group = digest
        others = path[i + 1:i + 1 + 32 * n].hex()
        digest = hashlib.sha256((others[:64 * at] + digest + others[64 * at:]).encode()).hexdigest()
        i += 1 + 32 * n
    return group or digest, digest


def siblings(path: bytes) -> str:
    """All digests of a path, from leaf to root, left to right."""
    out, i = [], 0
    while i < len(path):
        n = path[i] >> 2 & 3
        out.append(path[i + 1:i + 1 + 32 * n].hex())
        i += 1 + 32 * n
    return "".join(out)


def climb(tree: int, level: int, first: int, width: int, digests: list[str], is_top: bool, one_group: bool,
          levels: int = BLOCK_LEVELS) -> tuple:
    """The nodes over a block of neighbours, from place ``first`` of a level that
    has ``width`` nodes: rows of a block's inner nodes, and the row it ends in."""
    rows, seams = [], is_top and level == 0
    for _ in range(levels):
        if width == 1:
            break
        above = []
        parent_width = -(-width // RUN)
        for at in range(0, len(digests), RUN):
            run = digests[at:at + RUN]
            if parent_width > 1:
                up = (tree, (level + 1) << _LEVEL_BITS | (first + at) // RUN)
            else:
                up = (None, None) if is_top or one_group else (TOP, tree)
            for i, _ in enumerate(run):
                rows.append((level, first + at + i, width, run[i] if level == 0 and not is_top else None,
                             _step(run, i, seams), *up))
            above.append(_parent(run))
        digests, first, width, level, seams = above, first // RUN, parent_width, level + 1, False
    return rows, (level, first, width, digests)


def _built(nodes: DataFrame, carried: list[str], is_top: bool, one_group: bool, levels: int) -> DataFrame:
    """One pass up: the nodes below the next block border with their segments, and
    without segment the rows the blocks end in.  ``carried`` columns stay with the leaves."""
    kinds = ", ".join(f"`{c}` {nodes.schema[c].dataType.simpleString()}" for c in carried)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        arrow_kinds: list = []
        block, at_block = [], None

        def closed() -> list:
            tree, level, _ = at_block
            first, width = block[0][1], block[0][2]
            rows, (top_level, top_first, top_width, digests) = climb(
                tree, level, first, width, [b[0] for b in block], is_top, one_group, levels)
            out = []
            for n, row in enumerate(rows):
                own = block[n][3:] if n < len(block) and not is_top and level == 0 else (None,) * len(carried)
                out.append((tree, row[0], row[1], row[2], bytes.fromhex(row[3]) if row[3] else None, *row[4:], *own))
            if not rows and not is_top and level == 0:     # a group of one leaf, which is its root
                up = (None, None) if one_group else (TOP, tree)
                out.append((tree, 0, first, 1, bytes.fromhex(block[0][0]), b"", *up, *block[0][3:]))
            out += [(tree, top_level, top_first + i, top_width, bytes.fromhex(d), None, None, None, *(None,) * len(carried))
                    for i, d in enumerate(digests)]
            return out

        def batch_of(rows: list):
            columns = list(zip(*rows))
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(),
                     *arrow_kinds]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                              names=[*("tree level idx width digest seg up_tree up_at".split()), *carried])

        out: list = []
        for batch in batches:
            arrow_kinds = [batch.schema.field(c).type for c in carried]
            columns = [batch.column(batch.schema.names.index(c)).to_pylist()
                       for c in ("tree", "level", "idx", "digest", "width", *carried)]
            for tree, level, idx, digest, width, *own in zip(*columns):
                now = (tree, level, idx // RUN ** levels)
                if now != at_block:
                    if block:
                        out += closed()
                    block, at_block = [], now
                block.append((digest.hex(), idx, width, *own))
                if len(out) >= 8192:
                    yield batch_of(out)
                    out = []
        if block:
            out += closed()
        if out:
            yield batch_of(out)

    block = F.floor(F.col("idx") / F.lit(RUN ** levels))
    return (nodes.repartition("tree", block).sortWithinPartitions("tree", "level", "idx")
            .mapInArrow(run, _NODE + (", " + kinds if kinds else "")))


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``tree`` (the group's place among the groups, null first), ``idx`` (the
    row's place in its group by ``order``) and ``width`` (the group's rows).

    Places come from a range sort and the counts of its partitions, so no group is
    gathered; only one row a partition and group is summed over.
    """
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    laid = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
                  .withColumn("__seq", F.monotonically_increasing_id())
                  .withColumn("__part", F.shiftright("__seq", 33)), "ordered")
    spans = laid.groupBy("__part", F.col(group).alias("__group")).agg(
        F.min("__seq").alias("__from"), F.count("*").alias("__here"))
    whole = Window.partitionBy("__group")
    spans = stored(spans.select(
        "*", (F.sum("__here").over(whole.orderBy("__part")) - F.col("__here")).alias("__before"),
        F.sum("__here").over(whole).alias("width")), "group-spans")
    named = _numbered(spans.select("__group").distinct(), "__group")
    spans = (spans.withColumnRenamed("__part", "__p").join(
        named.withColumnRenamed("__group", "__named"), F.col("__group").eqNullSafe(F.col("__named"))).drop("__named"))
    same = (laid["__part"] == spans["__p"]) & laid[group].eqNullSafe(spans["__group"])
    return (laid.join(spans, same)
            .withColumn("idx", F.col("__seq") - F.col("__from") + F.col("__before"))
            .select(*rows.columns, F.col("__no").alias("tree"), "idx", "width"))


def _numbered(values: DataFrame, column: str) -> DataFrame:
    """Distinct values with their place ``__no`` in ascending order, null first."""
    order = F.col(column).asc_nulls_first()
    laid = stored(values.repartitionByRange(order).sortWithinPartitions(order)
                  .withColumn("__seq", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("__seq", 33)
    # one row a range partition
    counts = laid.groupBy(part.alias("__part")).agg(F.count("*").alias("__here"))
    starts = counts.select("__part", (F.sum("__here").over(Window.orderBy("__part")) - F.col("__here")).alias("__base"))
    low = F.col("__seq").bitwiseAND(F.lit((1 << 33) - 1))
    return laid.join(starts, part == starts["__part"]).select(column, (F.col("__base") + low).alias("__no"))


def _jump(nodes: DataFrame, ancestors: DataFrame, small: bool) -> DataFrame:
    """One round: every node's segment goes on with that of the ancestor it ends at."""
    far = ancestors.select(F.col("tree").alias("__t"), F.shiftleft(F.col("level").cast("bigint"), _LEVEL_BITS)
                           .bitwiseOR(F.col("idx")).alias("__a"), F.col("seg").alias("__seg"),
                           F.col("up_tree").alias("__ut"), F.col("up_at").alias("__ua"))
    far = F.broadcast(far) if small else far
    # a node that has reached the root looks for nothing; keys of its own deal such nodes out evenly
    done = F.col("up_tree").isNull()
    tree = F.when(done, F.lit(-2)).otherwise(F.col("up_tree"))
    at = F.when(done, F.xxhash64("tree", "idx")).otherwise(F.col("up_at"))
    keyed = nodes.withColumns({"__kt": tree, "__ka": at})
    joined = keyed.join(far, (F.col("__kt") == F.col("__t")) & (F.col("__ka") == F.col("__a")), "left")
    kept = [c for c in nodes.columns if c not in ("seg", "up_tree", "up_at")]
    return joined.select(*kept, F.concat("seg", F.coalesce("__seg", F.lit(b""))).alias("seg"),
                         F.col("__ut").alias("up_tree"), F.col("__ua").alias("up_at"))


def paths(leaves: DataFrame, group: str, order: list[str], digest: str = "leaf",
          keep: tuple[str, ...] = (), block_levels: int = BLOCK_LEVELS,
          broadcast_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, str | None]:
    """Every leaf's whole path, and the root's digest (None for an empty table).

    ``leaves`` is a stored table with the binary column ``digest``.  Rows: ``keep``,
    ``digest`` and ``seg`` (see ``fold``).  Leaves ascend by ``order`` in their
    group, null first; rows equal in all of it are neighbours in any order.
    """
    spark = leaves.sparkSession
    carried = list(keep)
    at = placed(leaves.select(*dict.fromkeys([*keep, group, *order, digest])), group, order)
    level = at.select("tree", F.lit(0).alias("level"), "idx", F.col(digest).alias("digest"), "width", *carried)
    level = stored(level, "leaves")
    sizes = level.agg(F.max("width"), F.max("tree")).first()
    if sizes[0] is None:
        return spark.createDataFrame([], leaves.select(*carried, digest).schema).withColumn(
            "seg", F.lit(b"")), None
    widest, groups = sizes[0], sizes[1] + 1
    one_group = groups == 1

    parts, roots, open_ = [], [], level
    for _ in range(max(1, -(-height(widest) // block_levels))):
        built = stored(_built(open_, carried, False, one_group, block_levels), "tree")
        parts.append(built.where("seg is not null"))
        ends = built.where("seg is null")
        roots.append(ends.where("width = 1"))
        open_ = ends.where("width > 1")
    subroots = roots[0]
    for more in roots[1:]:
        subroots = subroots.unionByName(more)
    top = subroots.select(F.lit(TOP).cast("bigint").alias("tree"), F.lit(0).alias("level"), F.col("tree").alias("idx"),
                          "digest", F.lit(groups).cast("bigint").alias("width"))
    for _ in range(max(1, -(-height(groups) // block_levels))):
        built = stored(_built(top, [], True, False, block_levels), "tree")
        for c in carried:
            built = built.withColumn(c, F.lit(None).cast(level.schema[c].dataType))
        parts.append(built.where("seg is not null"))
        top = built.where("seg is null").select("tree", "level", "idx", "digest", "width")
    root = top.first()["digest"].hex()

    nodes = parts[0]
    for more in parts[1:]:
        nodes = nodes.unionByName(more)
    leaf = (F.col("level") == 0) & (F.col("tree") != TOP)
    found = nodes.where(leaf).select("tree", "idx", "digest", "seg", "up_tree", "up_at", *carried)
    inner = nodes.where(~leaf).select("tree", "level", "idx", "seg", "up_tree", "up_at")
    # a lone leaf has an empty step to the root of its group
    longest, distance = max(1, height(widest)) + height(groups), 1
    while distance < longest:
        # at this distance nobody looks for a node of a group's tree below level `distance`
        inner = inner.where((F.col("tree") == TOP) | (F.col("level") >= distance))
        size = inner.count() * (96 + 2 * (1 + 32 * (RUN - 1)) * distance)
        small = size <= broadcast_bytes
        found = _jump(found, inner, small)
        distance *= 2
        if distance < longest:
            inner = stored(_jump(inner.where((F.col("tree") == TOP) | (F.col("level") >= distance)), inner, small), "jumped")
    return found.select(*carried, F.col("digest").alias(digest), "seg"), root


def verify(docs: DataFrame, key: str = "doc_id", group: str = "source", fields: tuple[str, ...] = FIELDS,
           altered: dict[str, Column] | None = None, where: Column | None = None,
           block_levels: int = BLOCK_LEVELS, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Prove every row of ``docs`` against the manifest's root, after some rows were
    altered: ``key, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``altered`` maps fields to what tampering makes of them in the rows ``where``
    holds (not where it is null).  Null fields have a digest of their own, apart from
    empty ones; a null group comes first; repeated keys and rows are leaves each; no rows
    give no rows.  Columns that ``fields`` does not name change nothing.
    """
    kind = docs.schema[key].dataType.simpleString()
    plain = leaf_digest([F.col(f) for f in fields])
    changed = F.lit(None).cast("binary")
    if altered and where is not None:
        changed = F.when(where, leaf_digest([altered.get(f, F.col(f)) for f in fields]))
    leaves = stored(docs.select(F.col(key).alias("__key"), F.col(group).alias("__by"), plain.alias("__leaf"),
                                changed.alias("__changed")), "leaf-digests")
    found, root = paths(leaves, "__by", ["__key", "__leaf"], "__leaf", ("__key", "__changed"),
                        block_levels, broadcast_bytes)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            column = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names) if n != "__key"}
            for leaf, changed, path in zip(column["__leaf"], column["__changed"], column["seg"]):
                group_root, _ = fold(leaf.hex(), path)
                _, folded = fold((changed or leaf).hex(), path)
                rows.append((leaf.hex(), group_root, hashlib.sha256(siblings(path).encode()).hexdigest(), folded))
            columns = list(zip(*rows)) or [()] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.names.index("__key")), *(pa.array(c, pa.string()) for c in columns)],
                names=[key, "leaf", "subroot", "proof_sha256", "folded_root"])

    proven = found.mapInArrow(
        run, f"`{key}` {kind}, leaf string, subroot string, proof_sha256 string, folded_root string")
    return proven.select(key, "leaf", "subroot", F.lit(root).cast("string").alias("root"), "proof_sha256", "folded_root",
                         (F.col("folded_root") == F.lit(root)).alias("verified"))


def without_breaks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[dict[str, Column], Column]:
    """Tampering that deletes line breaks from texts, in rows whose key has an even CRC-32."""
    return ({text: F.replace(F.col(text), F.lit("\n"), F.lit(""))},
            F.coalesce(F.crc32(F.col(key).cast("string")) % 2 == 0, F.lit(False)))
