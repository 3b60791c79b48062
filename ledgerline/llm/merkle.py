"""Merkle manifest of a dataset with octopus multiproofs.

Every row is a leaf; the leaves of one source, in order of their id, form a
tree with ``ARITY`` children a node, and the sources' roots, in order of the
source, form the top tree.

*Order.*  One range sort gives every row its place: the sorted partitions' row
counts (one row per task) make the offsets.  A source of any size spreads over
many tasks.

*Nodes.*  Aligned blocks of ``ARITY ** BLOCK_LEVELS`` nodes of a tree are
streamed through a task, which writes all their inner nodes; the block roots
are the next round's leaves, so a tree of 10^11 rows takes four rounds.

*Proofs.*  A leaf partition is a run of ``chunk`` rows of the whole order and
may hold parts of a source, whole sources or many.  It computes the smallest
set of node coordinates that its own leaves do not determine, in all trees that
it touches and in the top tree; all partitions' sets are fetched by one join
with the stored nodes.  The partition then derives the shared inner nodes, each
once, and expands one proof per leaf.  About two nodes per level are fetched
for a whole partition instead of two per level and leaf.

Defined cases: null ids come first, null sources are one source (the first);
equal ids follow in the order of their leaf, equal rows are leaves of their own
with interchangeable places; null and empty texts differ in the leaf; a very
long text is hashed whole; a source of one row is its own root, as is a single
source; extra columns, also with the names used here, are not read; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise

ARITY = 3
#: Levels that one round builds within a task: blocks of 2,187 nodes.
BLOCK_LEVELS = 7
#: Leaves of one partition of the proofs.
CHUNK = 4096
TOP = -1
_ROWS_OUT = 512

NODE_SCHEMA = "tree bigint, level int, idx bigint, size bigint, digest string"
COORD_SCHEMA = "chunk bigint, tree bigint, level int, idx bigint"
STEP = "array<struct<before:string,after:string>>"


def leaf_hash(*values: Column) -> Column:
    """sha256 of the values, each ``-`` if null, else byte count, colon and text."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")),
                        F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts), 256)


def fold(leaf: Column, steps: Column) -> Column:
    """Root that follows from a leaf and its proof."""
    return F.aggregate(steps, leaf, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def siblings(steps: Column) -> Column:
    """The proof's digests, level by level and left to right, joined."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), "")


def _hash(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def _depth(size: int) -> int:
    n = 0
    while size > 1:
        size, n = -(-size // ARITY), n + 1
    return n


def placed(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df``, stored, with ``place``: its row number from 0 in ``order``."""
    stored = materialise(df.orderBy(*order).withColumn("at", F.monotonically_increasing_id()), name)
    part = F.shiftright("at", 33)
    rows = stored.groupBy(part.alias("part")).agg(F.count("*").alias("rows"))  # a row per task
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("before"))
    inside = F.col("at").bitwiseAND((1 << 33) - 1)
    return (stored.withColumn("part", part).join(F.broadcast(rows), "part")
            .withColumn("place", F.col("before") + inside).drop("part", "before", "at"))


def block_nodes(rows: Iterator[tuple[int, int, int, str]], base: int,
                levels: int) -> Iterator[tuple[int, int, int, int, str]]:
    """Inner nodes of ``levels`` levels above ``rows`` (tree, idx, size of the
    level, digest), which come block by block: (tree, level, idx, size, digest)."""
    width, held, key, size = ARITY ** levels, [], None, 0

    def close() -> Iterator[tuple[int, int, int, int, str]]:
        level, first, n, nodes = base, key[1] * width, size, held
        while n > 1 and level < base + levels:
            nodes = [_hash(nodes[i:i + ARITY]) for i in range(0, len(nodes), ARITY)]
            level, first, n = level + 1, first // ARITY, -(-n // ARITY)
            for i, digest in enumerate(nodes):
                yield key[0], level, first + i, n, digest

    for tree, idx, n, digest in rows:
        if key != (tree, idx // width):
            if held:
                yield from close()
            key, held, size = (tree, idx // width), [], n
        held.append(digest)
    if held:
        yield from close()


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, at_once: int = 10_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)

    for row in rows:
        held.append(row)
        if len(held) == at_once:
            yield batch()
            held = []
    if held:
        yield batch()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns))


_NODE_ARROW = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("size", pa.int64()),
                         ("digest", pa.string())])


def inner_nodes(leaves: DataFrame, largest: int, name: str) -> list[DataFrame]:
    """All inner nodes of the trees over ``leaves`` (tree, idx, size, digest),
    the largest of which has ``largest`` leaves; one stored frame a round."""
    out, level, base, levels = [], leaves, 0, BLOCK_LEVELS
    while base < _depth(largest):
        def build(batches: Iterator[pa.RecordBatch], base: int = base) -> Iterator[pa.RecordBatch]:
            yield from _in_batches(block_nodes(_rows(batches), base, levels), _NODE_ARROW)

        src = (level.where("size > 1").select("tree", "idx", "size", "digest")
               .repartition("tree", F.expr(f"idx div {ARITY ** levels}")).sortWithinPartitions("tree", "idx"))
        out.append(materialise(src.mapInArrow(build, NODE_SCHEMA), f"{name}-{base}"))
        base += levels
        level = out[-1].where(F.col("level") == base)
    return out


def missing_nodes(held: dict[int, tuple[set[int], int]], n_trees: int) -> list[tuple[int, int, int]]:
    """Smallest set of coordinates (tree, level, idx) that, with the held leaves
    (by tree: places, and leaves of the tree), determines all their proofs."""
    out = []
    for tree, (known, size) in [*held.items(), (TOP, (set(held), n_trees))]:
        level = 0
        while size > 1:
            above = {i // ARITY for i in known}
            out += [(tree, level, i) for p in above for i in range(p * ARITY, min(p * ARITY + ARITY, size))
                    if i not in known]
            known, size, level = above, -(-size // ARITY), level + 1
    return out


def _coordinates(batches: Iterator[pa.RecordBatch], n_trees: int) -> Iterator[tuple[int, int, int, int]]:
    chunk, held = None, {}
    for c, tree, idx, size in _rows(batches):
        if c != chunk:
            if held:
                yield from ((chunk, *m) for m in missing_nodes(held, n_trees))
            chunk, held = c, {}
        held.setdefault(tree, (set(), size))[0].add(idx)
    if held:
        yield from ((chunk, *m) for m in missing_nodes(held, n_trees))


class _Partition:
    """Nodes of one leaf partition: its leaves, the fetched ones and all that follow from them."""

    def __init__(self, fetched: dict[tuple[int, int, int], str], held: dict[int, tuple[dict[int, str], int]],
                 n_trees: int):
        self.node, self.size, self.n_trees = dict(fetched), {}, n_trees
        roots = {tree: self._derive(tree, leaves, size) for tree, (leaves, size) in held.items()}
        self.subroot, self.root = roots, self._derive(TOP, roots, n_trees)
        self._steps: dict[tuple[int, int, int], list[tuple[str, str]]] = {}

    def _derive(self, tree: int, known: dict[int, str], size: int) -> str:
        """Every inner node above ``known`` once, up to the root."""
        self.size[tree], level = size, 0
        self.node.update(((tree, 0, i), d) for i, d in known.items())
        places = set(known)
        while size > 1:
            places = {i // ARITY for i in places}
            for p in places:
                self.node[tree, level + 1, p] = _hash([self.node[tree, level, i] for i in
                                                       range(p * ARITY, min(p * ARITY + ARITY, size))])
            size, level = -(-size // ARITY), level + 1
        return self.node[tree, level, 0]

    def steps(self, tree: int, level: int, idx: int, size: int) -> list[tuple[str, str]]:
        """Siblings before and after the path's node, from this level to the root."""
        key = (tree, level, idx)
        if key not in self._steps:
            if size <= 1:
                up = [] if tree == TOP else self.steps(TOP, 0, tree, self.n_trees)
            else:
                first = idx - idx % ARITY
                run = [self.node[tree, level, i] for i in range(first, min(first + ARITY, size))]
                up = [("".join(run[:idx - first]), "".join(run[idx - first + 1:])),
                      *self.steps(tree, level + 1, idx // ARITY, -(-size // ARITY))]
            if level == 0 and tree != TOP:
                return up  # a leaf's own, used once
            self._steps[key] = up
        return self._steps[key]


def _expand(table: pa.Table, n_trees: int) -> Iterator[pa.RecordBatch]:
    """The rows of one leaf partition with their proofs; fetched nodes come first."""
    col = {n: table.column(n).to_pylist() for n in ("tree", "level", "idx", "digest", "size")}
    n = sum(s is None for s in col["size"])
    fetched = dict(zip(zip(col["tree"][:n], col["level"][:n], col["idx"][:n]), col["digest"][:n]))
    held: dict[int, tuple[dict[int, str], int]] = {}
    for tree, idx, digest, size in zip(*(col[c][n:] for c in ("tree", "idx", "digest", "size"))):
        held.setdefault(tree, ({}, size))[0][idx] = digest
    part = _Partition(fetched, held, n_trees)
    for at in range(n, table.num_rows, _ROWS_OUT):
        some = table.slice(at, _ROWS_OUT).combine_chunks().to_batches()[0]
        own = list(zip(*(col[c][at:at + _ROWS_OUT] for c in ("tree", "idx", "size"))))
        steps = [part.steps(tree, 0, idx, size) for tree, idx, size in own]
        flat = [s for one in steps for s in one]
        ends = np.cumsum([0, *map(len, steps)]).astype(np.int32)
        proof = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(
            [pa.array([s[0] for s in flat], pa.string()), pa.array([s[1] for s in flat], pa.string())],
            ["before", "after"]))
        arrays = [some.column(c) for c in ("kept", "digest")]
        arrays += [pa.array([part.subroot[t] for t, _, _ in own]), pa.array([part.root] * len(own)), proof]
        yield pa.RecordBatch.from_arrays(arrays, ["kept", "leaf", "subroot", "root", "steps"])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one leaf partition at a time."""
    held, current = [], None
    for b in batches:
        ids = b.column("chunk").to_numpy()
        edges = [0, *(np.flatnonzero(ids[1:] != ids[:-1]) + 1).tolist(), len(ids)]
        for lo, hi in zip(edges, edges[1:]):
            if lo == hi:
                continue
            if held and ids[lo] != current:
                yield pa.Table.from_batches(held)
                held = []
            current = ids[lo]
            held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def multiproofs(docs: DataFrame, leaf_cols: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
                id_col: str = "doc_id", source_col: str = "source", claimed: Column | None = None,
                wanted: Column | None = None, chunk: int = CHUNK) -> DataFrame:
    """A row per document (or per ``wanted`` one): doc_id, source, leaf,
    subroot, root, steps (its proof: per level the siblings before and after
    the path's node, joined) and claimed, the leaf that a holder claims to
    have (null without ``claimed``)."""
    leaf = leaf_hash(*(F.col(c) for c in leaf_cols))
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), leaf.alias("leaf"),
                      (F.lit(None).cast("string") if claimed is None else claimed).alias("claimed"),
                      F.lit(True).alias("wanted") if wanted is None else F.coalesce(wanted, F.lit(False)).alias("wanted"))
    src = materialise(src, "merkle-leaves")  # the texts are read once
    rows = placed(src, [F.asc_nulls_first("source"), F.asc_nulls_first("doc_id"), F.asc("leaf")], "merkle-order")
    sources = rows.groupBy(F.col("source").alias("of")).agg(F.min("place").alias("first"), F.count("*").alias("size"))
    sources = materialise(placed(sources, [F.asc("first")], "merkle-sources").withColumnRenamed("place", "tree"),
                          "merkle-trees")
    found = sources.agg(F.count("*").alias("n"), F.max("size").alias("largest")).first()
    leaves = materialise(rows.join(sources, rows["source"].eqNullSafe(sources["of"]))
                         .select("doc_id", "source", "claimed", "wanted", "place", "tree", "size",
                                 (F.col("place") - F.col("first")).alias("idx"), F.col("leaf").alias("digest")),
                         "merkle-placed")
    level0 = leaves.select("tree", F.lit(0).alias("level"), "idx", "size", "digest")
    trees = inner_nodes(level0, found.largest or 0, "merkle-nodes")
    top0 = None
    for frame in [level0, *trees]:  # the roots of the sources
        roots = frame.where("size = 1").select(F.lit(TOP).cast("long").alias("tree"), F.lit(0).alias("level"),
                                               F.col("tree").alias("idx"), F.lit(found.n).cast("long").alias("size"),
                                               "digest")
        top0 = roots if top0 is None else top0.unionByName(roots)
    nodes = level0
    for frame in [*trees, top0, *inner_nodes(top0, found.n, "merkle-top")]:
        nodes = nodes.unionByName(frame)

    n_trees = found.n
    asked = (leaves.where("wanted").withColumn("chunk", F.expr(f"place div {chunk}")))
    coord = pa.schema([("chunk", pa.int64()), ("tree", pa.int64()), ("level", pa.int32()), ("idx", pa.int64())])

    def coordinates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _in_batches(_coordinates(batches, n_trees), coord)

    # the coordinates need places only, so a range of places is what moves
    lacking = materialise(asked.select("chunk", "tree", "idx", "size").repartition("chunk")
                          .sortWithinPartitions("chunk", "tree", "idx").mapInArrow(coordinates, COORD_SCHEMA),
                          "merkle-missing")
    fetched = lacking.join(nodes.drop("size"), ["tree", "level", "idx"])
    kept = F.struct("doc_id", "source", "claimed")
    kept_type = asked.select(kept.alias("k")).schema["k"].dataType.simpleString()
    both = asked.select("chunk", "place", "tree", F.lit(0).alias("level"), "idx", "size", "digest", kept.alias("kept"))
    both = both.unionByName(fetched.select("chunk", F.lit(-1).cast("long").alias("place"), "tree", "level", "idx",
                                           F.lit(None).cast("long").alias("size"), "digest",
                                           F.lit(None).cast(kept_type).alias("kept")))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _chunks(batches):
            yield from _expand(table, n_trees)

    proofs = (both.repartition("chunk").sortWithinPartitions("chunk", "place")
              .mapInArrow(expand, f"kept {kept_type}, leaf string, subroot string, root string, steps {STEP}"))
    return proofs.select("kept.doc_id", "kept.source", "leaf", "subroot", "root", "steps", "kept.claimed")
