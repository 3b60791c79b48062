"""SimHash near-duplicate groups by a binary-trie self-join.

1. Fingerprints: word shingles are hashed with XXH64; a bit of the 64-bit
   fingerprint is set when it is set in over half of the hashes.
2. Equal fingerprints collapse first, so copies never pair up.
3. The distinct fingerprints form a binary trie.  Node pairs are traversed
   together from (root, root), adding up the bits in which their prefixes
   differ; a pair over the bit budget is pruned with everything below it.  The
   upper levels are DataFrame joins of node counts, four bits at a time, and
   go on until a pair holds at most ``LEAF_ROWS`` fingerprints; then one task
   traverses the rest of that pair in numpy.  A crowded prefix is just
   traversed deeper, so no task ever holds more than ``LEAF_ROWS`` rows.
4. Each task returns a spanning forest of the links it found (at most one
   link per fingerprint); connected components follow by alternating
   large-star / small-star joins.

Defined cases: null text is empty; texts without words have fingerprint zero
and link like any other; fewer words than a shingle hash as one sequence;
repeated rows and repeated ids each return a row; null ids take part but never
name a component unless all its ids are null; extra input columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import materialise, text_key, text_of

#: Most fingerprints (both sides together) that one traversal task holds.
LEAF_ROWS = 65_536
#: Trie levels one DataFrame step descends.
STRIDE = 4
#: Node pairs a task expands at once; more are kept on a stack.
_FRONTIER = 262_144
#: Node pairs of at most this many combinations are compared leaf by leaf.
_SMALL = 8
_HASHES_AT_ONCE = 65_536
#: A fingerprint of more than one in HOT_SHARE of all rows (and over HOT_ROWS) is hot; there are fewer than HOT_SHARE.
HOT_SHARE = 100_000
HOT_ROWS = 1_000


def _fingerprint(text: bytes, shingle: int, seed: int) -> int:
    words = text.lower().split()       # bytes: lowers A-Z only, splits at ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        grams: Iterator = iter((tuple(words),))
        n = 1
    else:
        grams = zip(*(words[i:] for i in range(shingle)))
        n = len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for start in range(0, n, _HASHES_AT_ONCE):
        size = min(_HASHES_AT_ONCE, n - start)
        h = np.fromiter((digest(join(next(grams)), seed) for _ in range(size)), "<u8", size)
        ones += np.unpackbits(h.view(np.uint8).reshape(size, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, fp bigint) per row of ``docs``."""
    src = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"),
                      text_of(F.col(text_col)).cast("binary").alias("t"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [_fingerprint(x.as_py(), shingle, seed) for x in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps, pa.int64())],
                                             names=["doc_id", "text_key", "fp"])

    return src.mapInArrow(score, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, text_key bigint, fp bigint")


# --- traversal inside one task ---------------------------------------------------

def _find(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if np.array_equal(up, parent):
            return parent
        parent = up


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the classes of a[i] and b[i]; returns the flattened parents."""
    while a.size:
        parent = _find(parent)
        ra, rb = parent[a], parent[b]
        differ = ra != rb
        a, b, ra, rb = a[differ], b[differ], ra[differ], rb[differ]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
    return parent


def linked_classes(fps: np.ndarray, split: int, depth: int, diff: int, budget: int) -> np.ndarray:
    """Class of each fingerprint after a joint traversal of two trie nodes.

    ``fps[:split]`` and ``fps[split:]`` are the sorted unsigned leaves of the
    two nodes at ``depth``, whose prefixes differ in ``diff`` bits; ``split``
    0 means one node traversed with itself.
    """
    n = len(fps)
    parent = np.arange(n)
    own = split == 0
    start = (np.array([0]), np.array([n if own else split]), np.array([split]), np.array([n]),
             np.array([diff]))
    # a range of a sorted side is a trie node; searchsorted within a side needs that side only
    left, right = (fps, fps) if own else (fps[:split], fps[split:])
    off = 0 if own else split
    stack = [(depth, start)]
    while stack:
        depth, (alo, ahi, blo, bhi, diff_) = stack.pop()
        if alo.size > _FRONTIER:
            half = alo.size // 2
            cols = (alo, ahi, blo, bhi, diff_)
            stack += [(depth, tuple(c[half:] for c in cols)), (depth, tuple(c[:half] for c in cols))]
            continue
        na, nb = ahi - alo, bhi - blo
        small = na * nb <= _SMALL
        if small.any():
            sa, sb, ca, cb = alo[small], blo[small], na[small], nb[small]
            total = ca * cb
            owner = np.repeat(np.arange(total.size), total)
            k = np.arange(owner.size) - np.repeat(np.cumsum(total) - total, total)
            i, j = sa[owner] + k // cb[owner], sb[owner] + k % cb[owner]
            near = (np.bitwise_count(fps[i] ^ fps[j]) <= budget) & (i < j)
            parent = _unite(parent, i[near], j[near])
        big = ~small
        if depth >= 64 or not big.any():
            continue
        alo, ahi, blo, bhi, diff_ = (c[big] for c in (alo, ahi, blo, bhi, diff_))
        same = alo == blo
        bit = np.uint64(1 << (63 - depth))
        above = np.uint64(((1 << depth) - 1) << (64 - depth))
        amid = np.clip(np.searchsorted(left, (fps[alo] & above) | bit), alo, ahi)
        bmid = np.clip(np.searchsorted(right, (fps[blo] & above) | bit) + off, blo, bhi)
        children = [(alo, amid, blo, bmid, diff_), (amid, ahi, bmid, bhi, diff_),
                    (alo, amid, bmid, bhi, diff_ + 1)]
        cross = ~same
        children.append(tuple(c[cross] for c in (amid, ahi, blo, bmid, diff_ + 1)))
        nxt = tuple(np.concatenate(c) for c in zip(*children))
        alive = (nxt[4] <= budget) & (nxt[0] < nxt[1]) & (nxt[2] < nxt[3])
        # a node against itself with a single leaf has no pair left
        alive &= ~((nxt[0] == nxt[2]) & (nxt[1] == nxt[3]) & (nxt[1] - nxt[0] == 1))
        nxt = tuple(c[alive] for c in nxt)
        if nxt[0].size:
            stack.append((depth + 1, nxt))
    return _find(parent)


def _leaf_links(budget: int):
    import pandas as pd

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        fps = pdf["fp"].to_numpy().astype(np.int64).view(np.uint64)
        sides = pdf["side"].to_numpy()
        own = bool(pdf["own"].iloc[0])
        if own:
            order = np.argsort(fps)
            split = 0
        else:
            order = np.lexsort((fps, sides))
            split = int((sides == 0).sum())
        fps = np.ascontiguousarray(fps[order])
        root = linked_classes(fps, split, int(pdf["depth"].iloc[0]), int(pdf["diff"].iloc[0]), budget)
        moved = root != np.arange(len(fps))
        return pd.DataFrame({"a": fps[moved].view(np.int64), "b": fps[root[moved]].view(np.int64)})

    return run


# --- traversal of the upper levels -----------------------------------------------

def _prefix(fp, depth: int):
    return F.shiftrightunsigned(fp, 64 - depth) if depth else F.lit(0).cast("long")


def near_links(distinct_fps: DataFrame, max_bits: int = 2, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """Links (a, b) whose transitive closure equals that of all pairs of
    fingerprints at most ``max_bits`` apart.  ``distinct_fps``: column fp,
    no value twice; it is read once per step, so pass a stored frame."""
    spark = distinct_fps.sparkSession
    n = distinct_fps.count()
    pairs = spark.createDataFrame([(0, 0, 0, n, n)], "p bigint, q bigint, diff int, np bigint, nq bigint")
    size = F.when(F.col("p") == F.col("q"), F.col("np")).otherwise(F.col("np") + F.col("nq"))
    ready, depth = [], 0
    while True:
        done = pairs.filter(size <= leaf_rows) if depth < 64 else pairs
        ready.append(done.withColumn("depth", F.lit(depth)))
        todo = pairs.filter(size > leaf_rows)
        if depth >= 64 or (n <= leaf_rows and depth == 0) or todo.isEmpty():
            break
        depth += STRIDE
        parents = todo.select(F.col("p").alias("up")).union(todo.select(F.col("q").alias("up"))).distinct()
        nodes = (distinct_fps.groupBy(_prefix(F.col("fp"), depth).alias("node")).agg(F.count("*").alias("n"))
                 .withColumn("up", F.shiftrightunsigned("node", STRIDE)).join(parents, "up", "left_semi"))
        nodes = materialise(nodes, f"simhash-nodes-{depth}")
        a = nodes.select(F.col("up").alias("p"), F.col("node").alias("p2"), F.col("n").alias("np2"))
        b = nodes.select(F.col("up").alias("q"), F.col("node").alias("q2"), F.col("n").alias("nq2"))
        differ = F.bit_count(F.col("p2").bitwiseXOR(F.col("q2"))).cast("int")
        # at most 16 x 16 children of one pair; the bits of the parents add nothing new to the xor
        pairs = (todo.select("p", "q").join(a, "p").join(b, "q")
                 .filter((F.col("p") != F.col("q")) | (F.col("p2") <= F.col("q2")))
                 .select(F.col("p2").alias("p"), F.col("q2").alias("q"), differ.alias("diff"),
                         F.col("np2").alias("np"), F.col("nq2").alias("nq"))
                 .filter(F.col("diff") <= max_bits))
        pairs = materialise(pairs, f"simhash-pairs-{depth}")
    todo_pairs = ready[0]
    for more in ready[1:]:
        todo_pairs = todo_pairs.unionByName(more)
    todo_pairs = todo_pairs.filter((F.col("p") != F.col("q")) | (F.col("np") > 1))
    depths = [i * STRIDE for i in range(len(ready))]
    own = F.col("p") == F.col("q")
    sides = F.when(own, F.array(F.struct(F.lit(0).alias("side"), F.col("p").alias("node")))).otherwise(
        F.array(F.struct(F.lit(0).alias("side"), F.col("p").alias("node")),
                F.struct(F.lit(1).alias("side"), F.col("q").alias("node"))))
    members = (todo_pairs.select("depth", "p", "q", "diff", own.alias("own"), F.explode(sides).alias("s"))
               .select("depth", "p", "q", "diff", "own", "s.side", "s.node"))
    leaves = distinct_fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(d).alias("depth"), _prefix(F.col("fp"), d).alias("node")) for d in depths])).alias("s"))
    leaves = leaves.select("fp", "s.depth", "s.node")
    return (leaves.join(members, ["depth", "node"])
            .groupBy("depth", "p", "q").applyInPandas(_leaf_links(max_bits), "a bigint, b bigint"))


# --- connected components ---------------------------------------------------------

def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node in ``links`` (a, b): root is the smallest
    node of its component.  Alternating large-star and small-star steps; every
    step is two aggregations or joins on one node, and is stored."""
    edges = materialise(links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .distinct(), "cc-edges")
    state = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        large = materialise(large, "cc-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
                 .select("e.u", "e.v").filter("u <> v").distinct())
        edges = materialise(small, "cc-small")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or now[0] == 0:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text", leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(doc_id, text_key, fp, group_fp, component_id) per row: rows whose
    fingerprints are linked, directly or through others, by at most
    ``max_bits`` differing bits share the smallest doc_id among them and
    group_fp, the group's smallest (signed) fingerprint."""
    fps = materialise(fingerprints(docs, shingle, seed, id_col, text_col), "simhash-fps")
    reps = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("n_rows")),
                       "simhash-reps")
    roots = components(near_links(reps.select("fp"), max_bits, leaf_rows))
    linked = roots.join(reps, roots["node"] == reps["fp"]).select("node", "root", "least_id")
    named = linked.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = linked.select("node", "root").join(named, "root").select(F.col("node").alias("fp"), "root", "component_id")
    classes = materialise(reps.join(named, "fp", "left")
                          .select("fp", F.coalesce("root", "fp").alias("group_fp"),
                                  F.when(F.col("root").isNull(), F.col("least_id")).otherwise(F.col("component_id"))
                                  .alias("component_id"), "n_rows"), "simhash-classes")
    return _members(fps, classes)


def _members(fps: DataFrame, classes: DataFrame) -> DataFrame:
    """Every row with its class.  The rows of hot fingerprints meet theirs by a
    broadcast bounded by HOT_SHARE and stay where they are; all others, none of
    which has many rows, join by shuffle."""
    total = classes.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    is_hot = F.col("n_rows") > max(HOT_ROWS, total // HOT_SHARE)
    hot = F.broadcast(classes.filter(is_hot))
    cold = fps.join(hot.select("fp"), "fp", "left_anti").join(classes.filter(~is_hot), "fp")
    columns = ["doc_id", "text_key", "fp", "group_fp", "component_id"]
    return fps.join(hot, "fp").select(*columns).unionByName(cold.select(*columns))


def fingerprint_hex(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
