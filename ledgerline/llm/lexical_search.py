"""Ranked lexical search by one automaton scan of the documents.

The distinct terms of the items, each between two guards (spaces), make one
Aho-Corasick automaton, which is broadcast.  A document is reduced to its terms
with single-byte guards around them (upper-case A-Z lowered, every separator a
guard) and read once by the automaton: the outputs are whole terms, counted
into term frequencies; no index over the documents is built.  Scores need the
corpus counts (documents, terms, document frequencies), which are sums over
the scan's counts, kept as one narrow row per document.  The second step turns
a block of those rows into scores, as the automaton's outputs map to items, and
each task keeps the best ``k`` per item; candidates meet in two rounds, so no
task gathers more than ``k`` rows per item, salt and earlier task.

The items are the stated query set.  ``max_pairs`` bounds the (term, item) pairs
of one automaton; more items go in blocks by a hash of their id, one scan each,
with the same result (one item's own terms are never split).

Defined cases: null and empty texts hold no term and are neither counted nor
found; null items and items without a term have no row; rows of one item id
are one item, its terms taken once; repeated documents are documents of their
own, equal scores follow in the order of doc_id (null last); a very long text
is scanned whole; extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_lower, materialise, split_words

#: Runs of these separate terms, a fixed value.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GUARD = 0x20
#: By byte: lower-case letter, digit and bytes from 0x80 stay, A-Z are lowered, the rest are guards.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else _GUARD
              for b in range(256))
MAX_PAIRS = 1_000_000
_SALTS = 64
#: Documents times (term, item) pairs that are scored at once.
_CELLS = 4_000_000
_NO_ID = np.iinfo(np.int64).max

COUNTS_SCHEMA = "doc_id bigint, n bigint, terms array<int>, tfs array<int>"


def guarded(text: bytes) -> bytes:
    """The text's terms with guards around each."""
    return b" " + text.translate(_FOLD) + b" "


def count_terms(folded: bytes) -> int:
    """Terms between guards: places where one begins."""
    inside = np.frombuffer(folded, np.uint8) != _GUARD
    return int(np.count_nonzero(inside[1:] & ~inside[:-1]))


def automaton(terms: list[str]):
    """Guarded automaton whose outputs are the places of ``terms``.  It reads
    bytes, each as the character of that number."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        found.add_word(f" {term.encode().decode('latin-1')} ", i)
    found.make_automaton()
    return found


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """Distinct (item_id, term)."""
    words = split_words(ascii_lower(F.col(text_col)), SEPARATORS)
    return items.select(F.col(id_col).alias("item_id"), F.explode(words).alias("term")).distinct()


def scan(docs: DataFrame, terms: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (terms of the text, with repeats), and the item terms found
    with their counts, for each document with a term."""
    shared = docs.sparkSession.sparkContext.broadcast(automaton(terms) if terms else None)
    second = itemgetter(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for b in batches:
            ids, ns, places, counts = [], [], [], []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                if not text.is_valid:
                    continue
                folded = guarded(text.as_buffer().to_pybytes())
                n = count_terms(folded)
                if n:
                    tf = Counter(map(second, machine.iter(folded.decode("latin-1")))) if machine else {}
                    ids.append(doc)
                    ns.append(n)
                    places.append(list(tf.keys()))
                    counts.append(list(tf.values()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(places, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int32()))], ["doc_id", "n", "terms", "tfs"])

    src = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, COUNTS_SCHEMA)


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class _Best:
    """The best ``k`` (score, doc_id) per item seen so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.bar = k, np.ones(n_items, np.int64)
        self.item, self.score, self.doc = (np.empty(0, np.int64) for _ in range(3))

    def add(self, scores: np.ndarray, docs: np.ndarray) -> None:
        """``scores``: documents x items."""
        row, item = np.nonzero(scores >= self.bar)
        if not len(row):
            return
        item, score, doc = (np.concatenate(p) for p in ((self.item, item), (self.score, scores[row, item]),
                                                        (self.doc, docs[row])))
        order = np.lexsort((doc, -score, item))
        item, score, doc = item[order], score[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = place < self.k
        self.item, self.score, self.doc = item[keep], score[keep], doc[keep]
        full = place == self.k - 1
        self.bar[item[full]] = score[full]


def best_documents(counts: DataFrame, pairs: list[tuple[int, int]], n_items: int, w: np.ndarray, n_docs: int,
                   n_terms: int, k: int) -> DataFrame:
    """Candidates (item, score, doc_id): each task's best ``k`` per item.
    ``pairs`` are (term place, item place)."""
    by_term = sorted(pairs)
    items = np.array([i for _, i in by_term], np.int64)
    first = np.searchsorted(np.array([t for t, _ in by_term], np.int64), np.arange(len(w) + 1))
    shared = counts.sparkSession.sparkContext.broadcast((w, items, first))
    at_once = max(1, _CELLS // max(1, len(pairs)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, items, first = shared.value
        best = _Best(n_items, k)
        for whole in batches:
            for at in range(0, whole.num_rows, at_once):
                b = whole.slice(at, at_once)
                n = b.column(1).to_numpy()
                sizes = np.diff(b.column(2).offsets.to_numpy())
                term = b.column(2).flatten().to_numpy()
                tf = b.column(3).flatten().to_numpy().astype(np.int64)
                m = 10 + (90 * n * n_docs) // n_terms
                row = np.repeat(np.arange(len(n)), sizes)
                part = w[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
                fan = first[term + 1] - first[term]  # each output goes to its items
                start = np.repeat(first[term] - np.concatenate(([0], np.cumsum(fan)[:-1])), fan) if len(fan) else fan
                cell = np.repeat(row, fan) * n_items + items[start + np.arange(len(start))]
                scores = np.zeros(len(n) * n_items, np.int64)
                np.add.at(scores, cell, np.repeat(part, fan))
                doc = b.column(0).fill_null(_NO_ID).to_numpy()
                best.add(scores.reshape(len(n), n_items), doc)
        doc = pa.array(best.doc, mask=best.doc == _NO_ID)
        yield pa.RecordBatch.from_arrays([pa.array(best.item), pa.array(best.score), doc], ["item", "score", "doc_id"])

    return counts.mapInArrow(run, "item bigint, score bigint, doc_id bigint")


def _ranked(found: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, max_pairs: int = MAX_PAIRS, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    terms = materialise(item_terms(items, item_col, item_text_col), "search-terms")
    blocks = -(-terms.count() // max_pairs)
    out = None
    for block in range(blocks):
        own = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        pairs = own.collect()  # about max_pairs rows of the stated query set
        words = sorted({p.term for p in pairs})
        place = {t: i for i, t in enumerate(words)}
        names = sorted({p.item_id for p in pairs}, key=lambda x: (x is None, x))
        item_at = {x: i for i, x in enumerate(names)}
        counts = materialise(scan(docs, words, id_col, text_col), "search-counts")
        total = counts.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not total.docs:
            continue
        df = np.zeros(len(words), np.int64)
        for r in counts.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            df[r["t"]] = r["count"]
        found = best_documents(counts, [(place[p.term], item_at[p.item_id]) for p in pairs], len(names),
                               weights(total.docs, df), total.docs, total.terms, k)
        found = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)))
        found = _ranked(_ranked(found, ["item", "salt"], k).drop("rank"), ["item"], k)
        ids = spark.createDataFrame(list(enumerate(names)), f"item bigint, item_id {terms.dtypes[0][1]}")
        found = ids.join(found, "item").select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], f"item_id {terms.dtypes[0][1]}, rank int, doc_id bigint, score bigint")
    return out
