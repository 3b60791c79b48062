"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

Examples: a bounded, documented sample of the labelled training rows
(``max_examples``, the smallest hashes of their ids).  Terms: every word that
``MIN_DF`` examples hold, and word beginnings that are significantly more
frequent in positive examples.  A term weighs its inverse document frequency
times a strength from ``EPS`` to 1: how significant (chi-squared over the whole
sample; copies of a text count once) and how pure it is for positive examples.
So a text with telling words lies near examples with the same ones, and any
other text near examples of its own wording.

The examples sit in an inverted index whose postings are cut into blocks of
examples; each (term, block) keeps its largest weight.  A search adds up these
maxima into an upper bound per block and opens blocks in descending order of
the bound until the k-th best cosine beats all that remain, so the k nearest
are exact.  Blocks hold examples with the same common words, which keeps the
bounds apart.  The vote of a document is the cosine-weighted share of positive
neighbours, shrunk towards zero evidence; isotonic regression on leave-one-out
votes of the examples, worked out in tasks, calibrates it.  All k neighbours
are returned as evidence with cosines and labels, so the vote can be checked.

Documents are scored in the tasks that read them; the index is bounded by the
texts of ``max_examples`` rows and is broadcast.

Defined cases: null text is empty; a text without any term has no neighbours
and gets the calibrated score of vote 0; a very long text is scored whole;
labels that are null or have a null doc_id are left out; without training
labels (or without any term) each score is the training share of positives,
0.5 if there is none; repeated rows each return a row; ties among neighbours
go to the smaller example number; extra columns of either table, whatever
their names, are ignored; empty tables give an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.calibration import isotonic_apply, isotonic_fit
from ledgerline.llm.common import crc_mod, materialise, text_of, unit_hash

MAX_EXAMPLES = 4_000
#: Strength of a term that says nothing about the label.
EPS = 0.02
#: Tasks that prepare the examples.
_TASKS = 32
PREFIXES = (4, 6)
MIN_DF = 3
MIN_CHI2 = 25.0
MIN_PURITY = 0.75      # least share of positive contexts of a term
MIN_PHI2 = 0.01        # effect size, chi-squared over the number of examples
K = 15
BLOCK = 128
_FIRST_BLOCKS = 6
SHRINK = 0.2
#: ASCII that is not a letter or digit separates words.
_SEPARATE = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(_SEPARATE).split()


def terms_of(word: bytes) -> list[bytes]:
    """The word (behind a space) and its beginnings of some bytes, so that
    inflected forms of one stem share a term."""
    return [b" " + word, *(word[:n] for n in PREFIXES if len(word) >= n)]


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers first[i] .. first[i] + size[i] - 1 of all i, in a row."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


class BlockMaxIndex:
    """Examples as unit TF-IDF vectors (term numbers, weights), searched exactly."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int, block: int = BLOCK):
        self.n, self.block = len(vectors), block
        self.n_blocks = -(-self.n // block) if self.n else 0
        sizes = [len(t) for t, _ in vectors]
        term = np.concatenate([t for t, _ in vectors]) if vectors else np.zeros(0, np.int64)
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)
        example = np.repeat(np.arange(self.n), sizes)
        order = np.lexsort((example, term))
        term, self.example, self.weight = term[order], example[order].astype(np.int32), weight[order].astype(np.float32)
        # entries: the postings of one term in one block, with their largest weight
        key = term * max(self.n_blocks, 1) + self.example // block
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else key
        self.first = np.append(first, len(key)).astype(np.int32)
        self.at_block = (self.example[first] // block).astype(np.int32)
        self.largest = np.maximum.reduceat(self.weight, first) if len(key) else self.weight
        self.entries = np.searchsorted(term[first], np.arange(n_terms + 1))
        self.by_example = self.wide = None

    def __getstate__(self):
        return self.__dict__ | {"by_example": None, "wide": None}

    def vector(self, example: int) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of an example, from its postings."""
        if self.by_example is None:
            order = np.argsort(self.example, kind="stable")
            self.by_example = order, np.searchsorted(self.example[order], np.arange(self.n + 1))
        order, at = self.by_example
        post = order[at[example]:at[example + 1]]
        entry = np.searchsorted(self.first, post, side="right") - 1
        return np.searchsorted(self.entries, entry, side="right") - 1, self.weight[post].astype(np.float64)

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and cosines of the k nearest examples with a positive
        cosine, best first.  ``skip`` leaves one example out."""
        if self.wide is None:       # as numpy computes with them; sent in half the width
            self.wide = (self.first.astype(np.int64), self.example.astype(np.int64), self.weight.astype(np.float64),
                         self.at_block.astype(np.int64), self.largest.astype(np.float64))
        first_post, example, weight, at_block, largest = self.wide
        begin = self.entries[terms]
        n_entries = self.entries[terms + 1] - begin
        entry = _ranges(begin, n_entries)
        q, block = np.repeat(weights, n_entries), at_block[entry]
        bound = np.bincount(block, q * largest[entry], self.n_blocks)
        order = np.argsort(-bound, kind="stable")
        best_e, best_s, at = np.zeros(0, np.int64), np.zeros(0), 0
        while at < len(order) and bound[order[at]] > 0:
            if at:      # all blocks whose bound beats the k-th best so far; what they find can only raise it
                least = best_s[k - 1] if len(best_s) >= k else 0.0
                until = int(np.count_nonzero(bound[order] + 1e-12 >= least))
            else:
                until = _FIRST_BLOCKS
            opened = order[at:max(until, at)]
            if not len(opened):
                break
            is_open = np.zeros(self.n_blocks, bool)
            is_open[opened] = True
            chosen = np.flatnonzero(is_open[block])
            e, qe = entry[chosen], q[chosen]
            begin = first_post[e]
            size = first_post[e + 1] - begin
            post = _ranges(begin, size)
            scores = np.bincount(example[post], np.repeat(qe, size) * weight[post], self.n)
            hit = np.flatnonzero(scores)
            hit = hit[hit != skip]
            if len(hit) > 8 * k:        # only what can still be among the k best is sorted
                hit = hit[scores[hit] >= np.partition(scores[hit], len(hit) - k)[len(hit) - k]]
            best_e, best_s = np.concatenate([best_e, hit]), np.concatenate([best_s, scores[hit]])
            first = np.lexsort((best_e, -best_s))[:k]
            best_e, best_s = best_e[first], best_s[first]
            at = max(until, at)
        return best_e, best_s


class Known(dict):
    """Term numbers of the words looked up so far, within a bound."""

    def __init__(self, at: dict[bytes, int]):
        super().__init__()
        self.at = at

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) > 200_000:
            self.clear()
        found = self[word] = tuple(self.at[t] for t in terms_of(word) if t in self.at)
        return found


class Voter:
    """Turns texts into votes; holds the whole, bounded model."""

    def __init__(self, terms: list[bytes], weight: list[float], examples: list[dict[int, int]], labels: list[int],
                 ids: list, k: int, shrink: float):
        self.at = {t: i for i, t in enumerate(terms)}
        self.weight, self.k, self.shrink = np.array(weight), k, shrink
        self.labels, self.ids = np.array(labels, np.float64), ids
        self.index = BlockMaxIndex([self.unit(c) for c in examples], len(terms))
        self.cache: dict = {}
        self.memo = Known(self.at)

    def __getstate__(self):
        return self.__dict__ | {"cache": {}, "memo": None}

    def __setstate__(self, state: dict):
        self.__dict__ |= state
        self.memo = Known(self.at)

    def unit(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        terms = np.fromiter(counts.keys(), np.int64, len(counts))
        v = (1.0 + np.log(np.fromiter(counts.values(), np.float64, len(counts)))) * self.weight[terms]
        norm = np.sqrt(v @ v)
        return terms, v / norm if norm else v

    def counts(self, text: bytes) -> dict[int, int]:
        """Terms of the text; each different word is looked up once."""
        words = Counter(words_of(text))
        ids = list(map(self.memo.__getitem__, words))
        terms = list(chain.from_iterable(ids))
        times = list(chain.from_iterable(map(repeat, words.values(), map(len, ids))))
        found = dict(zip(terms, times))
        if len(found) < len(terms):     # words share a beginning
            found = {}
            for t, n in zip(terms, times):
                found[t] = found.get(t, 0) + n
        return found

    def vote(self, terms: np.ndarray, weights: np.ndarray, skip: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        if not len(terms):
            return 0.0, np.zeros(0, np.int64), np.zeros(0)
        e, s = self.index.search(terms, weights, self.k, skip)
        return float((s * self.labels[e]).sum() / (s.sum() + self.shrink)), e, s

    def judge(self, text: bytes) -> tuple[float, list, list[float], list[int]]:
        """Vote, and the neighbours' ids, cosines and labels."""
        key = xxhash.xxh3_128_digest(text)
        if key not in self.cache:
            if len(self.cache) > 20_000:
                self.cache.clear()
            vote, e, s = self.vote(*self.unit(self.counts(text)))
            self.cache[key] = (vote, [self.ids[i] for i in e], s.tolist(), self.labels[e].astype(int).tolist())
        return self.cache[key]


def sample_examples(docs: DataFrame, labels: DataFrame, label_col: str, folds: int, held_out_fold: int,
                    max_examples: int, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, label, t) of at most ``max_examples`` labelled rows outside
    the held-out fold, the smallest id hashes."""
    known = (labels.select(F.col(id_col).alias("__lid"), F.col(label_col).cast("int").alias("label"))
             .filter(F.col("label").isNotNull() & F.col("__lid").isNotNull()
                     & (crc_mod(F.col("__lid"), folds) != held_out_fold)))
    chosen = known.orderBy(unit_hash(F.lit("examples"), "__lid"), "__lid", "label").limit(max_examples)
    texts = docs.select(F.col(id_col).alias("doc_id"), text_of(F.col(text_col)).cast("binary").alias("t"))
    # an id may repeat in docs: the bound holds for the different joined rows
    rows = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("__lid")).select("doc_id", "label", "t").distinct()
    return rows.orderBy(unit_hash(F.lit("examples"), "doc_id"), "doc_id", "label", "t").limit(max_examples)


def _term_counts(sample: DataFrame) -> DataFrame:
    """(term, positive, negative): different contexts (word before, word after)
    in which positive and negative examples hold the term first.  Copies of
    one text share their contexts, so a copied text does not make all of its
    words look significant."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for label, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                words = words_of(text)
                near: dict[bytes, int] = {}
                for before, w, after in zip([b"", *words], words, [*words[1:], b""]):
                    if b" " + w not in near:
                        context = xxhash.xxh32_intdigest(before + b" " + after) >> 1
                        for t in terms_of(w):
                            near.setdefault(t, context)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(near), pa.binary()), pa.array(list(near.values()), pa.int32()),
                     pa.array([label] * len(near), pa.int32())], names=["term", "context", "label"])

    rows = sample.select("label", "t").mapInArrow(run, "term binary, context int, label int")
    return (rows.groupBy("term", "context").agg(F.max("label").alias("label"))
            .groupBy("term").agg(F.sum("label").alias("positive"), F.sum(1 - F.col("label")).alias("negative")))


def _terms(sample: DataFrame, n: int, pos: int) -> tuple[list[bytes], list[float]]:
    """The terms of the examples and their weights; as many rows as a bounded
    sample has different words reach the driver."""
    a, b = F.col("positive").cast("double"), F.col("negative").cast("double")
    neg = n - pos
    c, d = F.greatest(float(pos) - a, F.lit(0.0)), F.greatest(float(neg) - b, F.lit(0.0))
    chi2 = n * (a * d - b * c) ** 2 / ((a + b) * F.greatest(c + d, F.lit(1.0)) * pos * neg)
    strong = F.least(chi2 / max(MIN_CHI2, MIN_PHI2 * n), F.lit(1.0))
    strength = F.when(a >= MIN_PURITY * (a + b), strong).otherwise(0.0)
    rows = (_term_counts(sample).select("term", (a + b).alias("df"), strength.alias("strength"))
            .filter((F.col("df") >= MIN_DF) & (F.col("term").startswith(F.lit(b" ")) | (F.col("strength") >= 1.0)))
            .orderBy("term").collect())
    return ([bytes(r["term"]) for r in rows],
            [(np.log((n + 1) / (r["df"] + 1)) + 1.0) * (EPS + (1 - EPS) * r["strength"] ** 2) for r in rows])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 4, held_out_fold: int = 2,
        max_examples: int = MAX_EXAMPLES, k: int = K, shrink: float = SHRINK, id_col: str = "doc_id",
        text_col: str = "text") -> tuple[Broadcast | None, tuple, float]:
    """(broadcast voter, isotonic knots, share of positives)."""
    spark = docs.sparkSession
    sample = sample_examples(docs, labels, label_col, folds, held_out_fold, max_examples, id_col, text_col)
    sample = materialise(sample.repartition(_TASKS, "doc_id", "t"), "toxicity-examples")
    n, pos = sample.agg(F.count("*"), F.sum("label")).first()
    share = pos / n if n else 0.5
    names, weight = _terms(sample, n, pos) if n and pos and pos < n else ([], [])
    if not names:
        return None, (np.array([]), np.array([])), share
    counter = Voter(names, weight, [], [], [], k, shrink)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [counter.counts(t) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([list(f) for f in found], pa.list_(pa.int32())),
                 pa.array([list(f.values()) for f in found], pa.list_(pa.int32()))],
                names=["doc_id", "label", "t", "c"])

    kind = sample.schema["doc_id"].dataType.simpleString()
    rows = sample.mapInArrow(vectors, f"doc_id {kind}, label int, t array<int>, c array<int>").collect()

    def common(r) -> list[int]:
        """The most frequent terms of an example: those of one wording share a block."""
        return [t for _, t in sorted(zip(r["c"], r["t"]), key=lambda x: (-x[0], x[1]))[:3]]

    rows.sort(key=lambda r: (common(r), str(r["doc_id"]), r["label"], sorted(zip(r["t"], r["c"]))))
    counts = [dict(zip(r["t"], r["c"])) for r in rows]
    voter = Voter(names, weight, counts, [r["label"] for r in rows], [r["doc_id"] for r in rows], k, shrink)
    shared = spark.sparkContext.broadcast(voter)

    def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for b in batches:
            found = [v.vote(*v.index.vector(i), skip=i)[0] for i in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.float64())], names=["id", "vote"])

    got = spark.range(0, len(rows), 1, _TASKS).mapInArrow(left_out, "id bigint, vote double").collect()
    votes = np.zeros(len(rows))
    votes[[r["id"] for r in got]] = [r["vote"] for r in got]
    return shared, isotonic_fit(votes, voter.labels, np.ones(len(votes))), share


def train_and_score(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 4,
                    held_out_fold: int = 2, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """(doc_id, held_out, vote, score, neighbours, cosines, neighbour_labels) per row."""
    shared, knots, share = fit(docs, labels, label_col, folds, held_out_fold, id_col=id_col, text_col=text_col, **kw)
    src = docs.select(F.col(id_col).alias("doc_id"), text_of(F.col(text_col)).cast("binary").alias("t"))
    held = (crc_mod(F.col("doc_id"), folds) == held_out_fold).alias("held_out")
    kind = src.schema["doc_id"].dataType.simpleString()
    evidence = f"neighbours array<{kind}>, cosines array<double>, neighbour_labels array<int>"
    if shared is None:
        none = [F.array().cast(t).alias(n) for n, t in (x.split(" ") for x in evidence.split(", "))]
        return src.select("doc_id", held, F.lit(0.0).alias("vote"), F.lit(float(share)).alias("score"), *none)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = shared.value
        for b in batches:
            got = [v.judge(t.as_py()) for t in b.column(1)]
            votes = np.array([g[0] for g in got])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(votes, pa.float64()), pa.array(isotonic_apply(knots, votes), pa.float64()),
                 pa.array([g[1] for g in got], pa.list_(b.schema.field(0).type)),
                 pa.array([g[2] for g in got], pa.list_(pa.float64())),
                 pa.array([g[3] for g in got], pa.list_(pa.int32()))],
                names=["doc_id", "vote", "score", "neighbours", "cosines", "neighbour_labels"])

    out = src.mapInArrow(run, f"doc_id {kind}, vote double, score double, {evidence}")
    return out.select("doc_id", held, "vote", "score", "neighbours", "cosines", "neighbour_labels")
