"""Merkle manifest and octopus multiproofs against a tree built by hand."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, place string, tree string, digest string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf_of(row):
    doc, text, lang, source, n = row
    return sha(*map(field, (doc, source, lang, n, text)))


def path(leaves, at):
    """(root, steps of one leaf) of a tree of runs of three."""
    steps = []
    while len(leaves) > 1:
        first = at - at % 3
        run = leaves[first:first + 3]
        steps.append(("".join(run[:at - first]), "".join(run[at - first + 1:])))
        leaves = [sha(*leaves[i:i + 3]) for i in range(0, len(leaves), 3)]
        at //= 3
    return leaves[0], steps


def manifest(rows):
    """{(source, place in it): (leaf, subroot, root, steps)}"""
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: [leaf_of(r) for r in sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))]
             for s in order}
    roots = [path(trees[s], 0)[0] for s in order]
    out = []
    for i, s in enumerate(order):
        root, above = path(roots, i)
        for at, leaf in enumerate(trees[s]):
            out.append((s, leaf, roots[i], root, path(trees[s], at)[1] + above))
    return out


def _rows(n, sources, seed=3):
    rnd = random.Random(seed)
    return [(i, rnd.choice([None, "", f"text {i}\nmore", "é" * 3]), rnd.choice(["en", None]),
             rnd.choice(sources), rnd.choice([None, i])) for i in range(n)]


CASES = {
    "many": _rows(400, ["a", "b", None, "é", "Z", "hot", "hot", "hot"]),
    "single": [(7, "x", "en", "s", 1)],
    "one source": _rows(82, ["s"]),
    "lone leaves": [(i, "t", None, f"s{i:02d}", None) for i in range(11)],
    "repeats": [(1, "x", "en", "s", 1)] * 5 + [(None, None, None, None, None)] * 4 + [(1, "y", "en", "s", 1), (2, "z" * 50_000, "en", "s", 1)],
}


@pytest.mark.parametrize("case", sorted(CASES))
@pytest.mark.parametrize("chunk", [5, 4096])
def test_proofs_equal_the_tree(spark, case, chunk, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)      # several rounds
    rows = CASES[case]
    docs = spark.createDataFrame([(*r, "p", "t", "d") for r in rows], SCHEMA).repartition(4)
    got = merkle.multiproofs(docs, chunk=chunk)
    got = got.withColumn("folded", merkle.fold(F.col("leaf"), F.col("steps"))).collect()
    want = sorted(map(str, manifest(rows)))
    assert sorted(str((r.source, r.leaf, r.subroot, r.root, [tuple(s) for s in r.steps])) for r in got) == want
    assert all(r.folded == r.root for r in got)


def test_a_changed_leaf_does_not_verify_and_wanted_rows_only(spark):
    rows = CASES["many"]
    docs = spark.createDataFrame([(*r, "p", "t", "d") for r in rows], SCHEMA)
    cut = merkle.leaf_hash(*(F.col(c) for c in ("doc_id", "source", "lang", "n_chars")), F.replace("text", F.lit("\n"), F.lit("")))
    proofs = merkle.multiproofs(docs, claimed=F.when(F.col("doc_id") % 2 == 0, cut), wanted=F.col("doc_id") % 7 < 3, chunk=64)
    proofs = proofs.withColumn("folded", merkle.fold(F.coalesce("claimed", "leaf"), F.col("steps"))).collect()
    assert sorted(r.doc_id for r in proofs) == [r[0] for r in rows if r[0] % 7 < 3]
    text = {r[0]: r[1] for r in rows}
    for r in proofs:
        changed = r.doc_id % 2 == 0 and "\n" in (text[r.doc_id] or "")
        assert (r.folded == r.root) == (not changed)
    full = {r.leaf: [tuple(s) for s in r.steps] for r in merkle.multiproofs(docs).collect()}
    assert all(full[r.leaf] == [tuple(s) for s in r.steps] for r in proofs)


def test_missing_nodes_are_the_smallest_set():
    rnd = random.Random(5)
    for _ in range(200):
        n = rnd.randint(1, 60)
        known = set(rnd.sample(range(n), rnd.randint(1, n)))
        found = {(lvl, i) for t, lvl, i in merkle.missing_nodes({0: (set(known), n)}, 1) if t == 0}
        # brute force: nodes that some leaf's proof needs and that no held leaf lies below
        need, size, level, held = set(), n, 0, set(known)
        while size > 1:
            for leaf in known:
                at = leaf // 3 ** level
                first = at - at % 3
                need |= {(level, i) for i in range(first, min(first + 3, size)) if i not in held}
            held, size, level = {i // 3 for i in held}, -(-size // 3), level + 1
        assert found == need


def test_empty_table(spark):
    assert merkle.multiproofs(spark.createDataFrame([], SCHEMA)).count() == 0
