"""Ranked lexical search against a plain count."""

import collections
import math
import random
import re

import pytest

from ledgerline.llm import lexical_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain_search(docs, items, k):
    counts = [(d, collections.Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    wanted = collections.defaultdict(set)
    for item, text in items:
        wanted[item] |= set(terms(text))
    out = []
    for item, words in wanted.items():
        scored = []
        for doc, c in counts:
            m = 100 - 90 + 90 * sum(c.values()) * n_docs // n_terms
            score = 0
            for w in words & c.keys():
                df = sum(w in other for _, other in counts)
                score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * (10 ** 9 * c[w] // (1000 * c[w] + 8 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, rank, doc, -s) for rank, (s, _, _, doc) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def _data():
    rnd = random.Random(4)
    words = ["Alpha", "beta", "gaméma", "DELTA", "e1", "1", "中文", "zeta", "Été"] + [f"w{i}" for i in range(40)]
    docs = [(i, rnd.choice([" ", "-", "\n", "@@"]).join(rnd.choices(words, weights=range(len(words), 0, -1), k=rnd.randint(0, 30))))
            for i in range(150)]
    docs += [(900 + i, "alpha beta beta") for i in range(30)]                  # copies: ties go to the smaller id
    docs += [(5000, None), (5001, ""), (5002, "--- !!"), (None, "alpha beta beta"), (3, "alpha"), (3, "alpha"),
             (5003, "beta " * 20_000)]
    items = [(1, "ALPHA, beta w3 w3"), (2, "gaméma été Été"), (3, None), (4, ""), (5, "nowhere"), (6, "alph alphabet lpha"),
             (7, "中文 1"), (1, "zeta"), (None, "w1 w2")]
    return docs, items


@pytest.mark.parametrize("max_pairs", [1_000_000, 3])
def test_search_equals_plain_counts(spark, max_pairs):
    docs, items = _data()
    dd = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, n int").repartition(5)
    bb = spark.createDataFrame([(*i, "x") for i in items], "item_id bigint, text string, term string")
    got = [tuple(r) for r in lexical_search.search(dd, bb, k=7, max_pairs=max_pairs).collect()]
    assert sorted(got, key=str) == plain_search(docs, items, 7)
    assert {r[0] for r in got} == {1, 2, 7, None}


def test_small_steps_and_empty_tables(spark, monkeypatch):
    docs, items = _data()
    dd = spark.createDataFrame(docs, "doc_id bigint, text string")
    bb = spark.createDataFrame(items, "item_id bigint, text string")
    monkeypatch.setattr(lexical_search, "_CELLS", 1)
    got = [tuple(r) for r in lexical_search.search(dd, bb, k=3).collect()]
    assert sorted(got, key=str) == plain_search(docs, items, 3)
    for d, b in ((dd.limit(0), bb), (dd, bb.limit(0)), (dd.where("doc_id >= 5000 AND doc_id < 5003"), bb)):
        out = lexical_search.search(d, b)
        assert out.count() == 0 and out.columns == ["item_id", "rank", "doc_id", "score"]


def test_terms_are_whole(spark):
    machine = lexical_search.automaton(["a b".split()[0], "ab", "b"])
    folded = lexical_search.guarded("Ab,a b..b éa aé".encode())
    assert lexical_search.count_terms(folded) == 6
    assert sorted(i for _, i in machine.iter(folded.decode("latin-1"))) == [0, 1, 2, 2]
