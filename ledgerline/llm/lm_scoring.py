"""Language-model scores from a log-bilinear neural model.

Token counts of all training texts give the unigram base score and the
vocabulary.  The model predicts a class from the two classes before it: their
embeddings, each through a matrix of its own, add up to a vector whose product
with the output embeddings (plus a bias) scores every class.  The most frequent
tokens are classes of their own; every other token belongs to one of
``ENDINGS`` classes by a hash of its last three bytes, inside which smoothed
counts decide, so that every token has an embedding and the probabilities of
all tokens (and one unseen token per class) add up to one.

Training is noise-contrastive estimation in numpy, in rounds of train and
average: the training texts, as class numbers, are dealt by a hash to
``ROUNDS`` slices and, within a slice, to parts whose number follows from the
token count alone (the square root of the millions of tokens); each part trains
in the order of the hash from the last average, and the round ends with the
average of its parts, model and AdaGrad sums, weighted by tokens.  The file
layout has no part in it, and the steps behind the model grow with the corpus.

Scoring needs normalised probabilities.  As the score is a sum of one part per
context class, the normaliser of every context pair is one matrix product,
``exp(A) @ exp(B).T``; a class's log-probability is then three table look-ups.

The ``HEAD`` most frequent tokens travel to the tasks as a table of bounded
size.  Counts of rarer tokens stay distributed: texts list their rare tokens,
which join the count table by shuffle.

Defined cases: null text is empty and has just the end token; a very long text
is scored whole, in arrays of its own length; repeated rows each return the
same scores; null ids belong to the fold of the empty string; without training
texts every count is 0 and the model is uniform; extra columns, whatever their
names, are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import crc_mod, materialise, text_key, text_of

VOCAB = 2048          # classes of the model
ENDINGS = 512         # of these, for tokens that are not among the most frequent
HEAD = 65_536         # tokens whose counts are sent to the tasks
DIM = 24
BATCH = 2048
NOISE = 64            # noise samples per batch, shared by its contexts
RATE = 0.12
ALPHA = 0.1
SEED = 5
END = b" "            # no word holds a blank
ROUNDS = 4
PART_TOKENS = 1_000_000   # tokens of one part, times the number of parts
_FLUSH = 300_000
_CHUNK = 2048
_SCORE = 50_000       # tokens that are scored together, beyond which a text ends
_LEARN = 200_000      # tokens that are shuffled together


def tokens_of(text: bytes) -> list[bytes]:
    """Words with A-Z lower-cased, split at ASCII white space, and the end."""
    words = text.lower().split()
    words.append(END)
    return words


# --- counts --------------------------------------------------------------------------

def token_counts(train: DataFrame) -> DataFrame:
    """(token, c) over all texts of ``train`` (column t, binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out():
            got = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()),
                                              pa.array(list(seen.values()), pa.int64())], names=["token", "c"])
            seen.clear()
            return got

        for b in batches:
            for t in b.column(0):
                seen.update(tokens_of(t.as_py()))
                if len(seen) > _FLUSH:
                    yield out()
        yield out()

    return train.select("t").mapInArrow(run, "token binary, c bigint").groupBy("token").agg(F.sum("c").alias("c"))


def frequent(counts: DataFrame, most: int) -> list[tuple[bytes, int]]:
    """At most ``most`` tokens, the most frequent, by count and then bytes.  A
    histogram of the logarithms finds the count from which they all fit."""
    level = F.floor(F.log2("c") * 64).cast("int")
    rows = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect()
    total, least = 0, None
    for r in sorted(rows, key=lambda r: -r["level"]):        # at most 64 * 63 levels
        total += r["n"]
        if total > most:
            break
        least = r["least"]
    if least is None:
        return []
    kept = [(bytes(r["token"]), r["c"]) for r in counts.filter(F.col("c") >= least).collect()]
    return sorted(kept, key=lambda x: (-x[1], x[0]))


def ending(token: bytes, endings: int) -> int:
    return zlib.crc32(token[-3:]) % endings


# --- model ---------------------------------------------------------------------------

@dataclass
class Model:
    r: np.ndarray       # (vocab + 1, dim): context embeddings; the last row is the start
    c1: np.ndarray      # (dim, dim), previous token
    c2: np.ndarray      # (dim, dim), the one before it
    q: np.ndarray       # (vocab, dim)
    b: np.ndarray       # (vocab,)

    @staticmethod
    def start(unigram: np.ndarray, dim: int, seed: int) -> Model:
        rng = np.random.default_rng(seed)
        v = len(unigram)
        f = np.float32
        return Model(rng.normal(0, 0.3, (v + 1, dim)).astype(f), np.eye(dim, dtype=f), 0.5 * np.eye(dim, dtype=f),
                     rng.normal(0, 0.05, (v, dim)).astype(f), np.log(unigram).astype(f))

    def parts(self) -> list[np.ndarray]:
        return [self.r, self.c1, self.c2, self.q, self.b]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in self.parts()])

    def like(self, flat: np.ndarray) -> Model:
        got, at = [], 0
        for p in self.parts():
            got.append(flat[at:at + p.size].reshape(p.shape).astype(np.float32))
            at += p.size
        return Model(*got)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A, B and log Z: the score of w after (c2, c1) is A[c1, w] + B[c2, w],
        its log-probability that less logZ[c1, c2]."""
        a = (self.r @ self.c1) @ self.q.T
        b = (self.r @ self.c2) @ self.q.T + self.b
        ma, mb = a.max(1, keepdims=True), b.max(1, keepdims=True)
        z = np.exp(a - ma) @ np.exp(b - mb).T
        return a, b, np.log(np.maximum(z, 1e-37)) + ma + mb.T


class Trainer:
    """Noise-contrastive estimation with AdaGrad on batches of contexts."""

    def __init__(self, start: Model, unigram: np.ndarray, noise: int, rate: float, seed: int,
                 sums: Model | None = None):
        self.m = Model(*[p.copy() for p in start.parts()])
        self.sums = [np.full(p.shape, 0.05, np.float32) if sums is None else sums.parts()[i].copy()
                     for i, p in enumerate(self.m.parts())]
        self.cum = np.cumsum(unigram)
        self.log_noise = np.log(noise * unigram).astype(np.float32)
        self.noise, self.rate = noise, rate
        self.rng = np.random.default_rng(seed)

    def step(self, c2: np.ndarray, c1: np.ndarray, w: np.ndarray) -> None:
        m, n = self.m, len(w)
        r1, r2 = m.r[c1], m.r[c2]
        h = r1 @ m.c1 + r2 @ m.c2
        qw = m.q[w]
        drawn = np.minimum(np.searchsorted(self.cum, self.rng.random(self.noise) * self.cum[-1]), len(self.cum) - 1)
        qn = m.q[drawn]
        up = 1.0 / (1.0 + np.exp(np.clip((h * qw).sum(1) + m.b[w] - self.log_noise[w], -30, 30)))
        down = -1.0 / (1.0 + np.exp(-np.clip(h @ qn.T + m.b[drawn] - self.log_noise[drawn], -30, 30)))
        gh = up[:, None] * qw + down @ qn
        gq = self._rows(w, up[:, None] * h, m.q.shape) + self._rows(drawn, down.T @ h, m.q.shape)
        gb = (np.bincount(w, up, len(m.b)) + np.bincount(drawn, down.sum(0), len(m.b)))
        gr = self._rows(np.concatenate([c1, c2]), np.concatenate([gh @ m.c1.T, gh @ m.c2.T]), m.r.shape)
        for p, s, g in zip(m.parts(), self.sums, (gr, r1.T @ gh, r2.T @ gh, gq, gb)):
            g = (g / n ** 0.5).astype(np.float32)
            s += g * g
            p += self.rate * g / np.sqrt(s)

    @staticmethod
    def _rows(ids: np.ndarray, g: np.ndarray, shape: tuple) -> np.ndarray:
        """Rows of ``g`` added up by id."""
        flat = (ids[:, None] * shape[1] + np.arange(shape[1])).ravel()
        return np.bincount(flat, g.ravel(), shape[0] * shape[1]).reshape(shape)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``rows`` rows, which bounds the arrays made of one."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


class Classes(dict):
    """Class of each token: the frequent tokens, and what was asked since, within a bound."""

    def __init__(self, words: list[bytes], endings: int):
        super().__init__({w: i for i, w in enumerate(words)})
        self.words, self.endings = words, endings

    def __missing__(self, token: bytes) -> int:
        if len(self) > len(self.words) + _FLUSH:
            self.clear()
            self.update({w: i for i, w in enumerate(self.words)})
        found = self[token] = len(self.words) + ending(token, self.endings)
        return found

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))


def _contexts(ids: np.ndarray, ends: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The two ids before each of ``ids``; ``ends`` marks last tokens of texts."""
    c1 = np.concatenate([[start], ids[:-1]])
    first = np.concatenate([[True], ends[:-1]])
    c1[first] = start
    c2 = np.concatenate([[start], c1[:-1]])
    c2[first] = start
    return c2, c1


def parts_for(n_tokens: int) -> int:
    """Parts of a round: the square root of the tokens in units of ``PART_TOKENS``."""
    return max(1, round((n_tokens / PART_TOKENS) ** 0.5))


def train_model(train: DataFrame, words: list[bytes], endings: int, unigram: np.ndarray, n_tokens: int,
                dim: int = DIM, seed: int = SEED, batch: int = BATCH, noise: int = NOISE, rate: float = RATE,
                rounds: int = ROUNDS) -> Model:
    """Train on ``train`` (columns t, the text, and h, a hash of the row)."""
    start_id, parts = len(unigram), parts_for(n_tokens)
    model, sums = Model.start(unigram, dim, seed), None

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = Classes(words, endings)
        for b in _slices(batches):
            ids = [classes.of(tokens_of(t.as_py())).astype("<u2").tobytes() for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(ids, pa.binary())], names=["h", "ids"])

    coded = train.select("t", "h").mapInArrow(encode, "h bigint, ids binary")
    coded = materialise(coded.withColumn("slice", F.pmod(F.xxhash64(F.lit(1), "h"), F.lit(rounds)).cast("int"))
                        .withColumn("part", F.pmod(F.xxhash64(F.lit(2), "h"), F.lit(parts)).cast("int")), "lm-coded")
    schema = "chunk int, weight double, spread int, v array<double>"

    def add(pdf):
        return pdf.iloc[:1].assign(weight=pdf["weight"].sum(), v=[np.sum(np.stack(pdf["v"].to_list()), axis=0)])

    for turn in range(rounds):
        def run(batches: Iterator[pa.RecordBatch], begin: Model = model, state: Model | None = sums,
                turn: int = turn) -> Iterator[pa.RecordBatch]:
            trainer, current, seen = None, None, 0

            def result() -> pa.RecordBatch:
                both = np.concatenate([trainer.m.flat(), np.concatenate([x.ravel() for x in trainer.sums])])
                flat = both.astype(np.float64) * seen
                chunks = [flat[i:i + _CHUNK] for i in range(0, len(flat), _CHUNK)]
                return pa.RecordBatch.from_arrays(
                    [pa.array(range(len(chunks)), pa.int32()), pa.array([float(seen)] * len(chunks), pa.float64()),
                     pa.array([current % 64] * len(chunks), pa.int32()), pa.array(chunks, pa.list_(pa.float64()))],
                    names=["chunk", "weight", "spread", "v"])

            held: list[np.ndarray] = []

            def learn() -> None:
                ends = np.zeros(sum(map(len, held)), bool)
                ends[np.cumsum([len(h) for h in held]) - 1] = True
                ids = np.concatenate(held).astype(np.int64)
                c2, c1 = _contexts(ids, ends, start_id)
                order = trainer.rng.permutation(len(ids))
                for i in range(0, len(ids), batch):
                    k = order[i:i + batch]
                    trainer.step(c2[k], c1[k], ids[k])
                held.clear()

            waiting = 0
            for b in batches:
                for part, ids in zip(b.column(0).to_pylist(), b.column(1)):
                    if part != current:
                        if trainer is not None:
                            if held:
                                learn()
                            yield result()
                        trainer = Trainer(begin, unigram, noise, rate, seed + 1000 * turn + part, state)
                        current, seen, waiting = part, 0, 0
                    held.append(np.frombuffer(ids.as_buffer(), "<u2"))
                    seen += len(held[-1])
                    waiting += len(held[-1])
                    if waiting >= _LEARN:
                        learn()
                        waiting = 0
            if trainer is not None:
                if held:
                    learn()
                yield result()

        rows = (coded.where(F.col("slice") == turn).select("part", "ids", "h").repartition(parts, "part")
                .sortWithinPartitions("part", "h", "ids").select("part", "ids"))
        # sums of sums: no group grows with all parts at once
        partial = rows.mapInArrow(run, schema).groupBy("chunk", "spread").applyInPandas(add, schema)
        got = sorted(partial.groupBy("chunk").applyInPandas(add, schema).collect(), key=lambda r: r["chunk"])
        if got:
            flat = np.concatenate([np.array(r["v"]) for r in got]) / got[0]["weight"]
            half = len(flat) // 2
            model, sums = model.like(flat[:half]), model.like(flat[half:])
    return model


# --- scores --------------------------------------------------------------------------

def score_texts(docs: DataFrame, folds: int = 10, held_out_fold: int = 0, vocab: int = VOCAB, head: int = HEAD,
                endings: int = ENDINGS, id_col: str = "doc_id", text_col: str = "text", **training) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score)
    per row; scores are log10."""
    src = docs.select(F.col(id_col).alias("doc_id"), text_key(F.col(text_col)).alias("text_key"),
                      (crc_mod(F.col(id_col), folds) == held_out_fold).alias("held_out"),
                      text_of(F.col(text_col)).cast("binary").alias("t"))
    train = src.filter(~F.col("held_out")).withColumn("h", F.xxhash64("doc_id", "text_key"))
    counts = materialise(token_counts(train), "lm-counts")
    n_all, v_all = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = frequent(counts, head)
    known = dict(top)
    words = [w for w, _ in top[:max(vocab - endings, 0)]]
    # tokens and different tokens per ending class, of all but the frequent tokens; `endings` rows
    by_end = counts.groupBy(F.pmod(F.crc32(F.substring("token", -3, 3)), F.lit(endings)).cast("int").alias("e")).agg(
        F.sum("c").alias("c"), F.count("*").alias("v")).collect()
    n_end, v_end = np.zeros(endings), np.zeros(endings)
    for r in by_end:
        n_end[r["e"]], v_end[r["e"]] = r["c"], r["v"]
    for w in words:
        n_end[ending(w, endings)] -= known[w]
        v_end[ending(w, endings)] -= 1
    unigram = np.array([*[known[w] for w in words], *n_end], np.float64) + ALPHA
    unigram /= unigram.sum()
    model = train_model(train, words, endings, unigram, n_all, **training)
    tables = docs.sparkSession.sparkContext.broadcast(model.tables())
    start, n_words, head_words = len(unigram), len(words), [w for w, _ in top]
    # by number of a token: place in the head, or behind it the ending of any other token
    class_of = np.array([*range(n_words), *(n_words + ending(w, endings) for w in head_words[n_words:]),
                         *range(n_words, n_words + endings)], np.int64)
    log_of = np.log10(np.array([c for _, c in top] + [1 - ALPHA] * endings, np.float64) + ALPHA)
    base_total = float(np.log10(n_all + ALPHA * (v_all + 1)))
    end_total = np.log10(n_end + ALPHA * (v_end + 1))
    # tokens in ending classes: their share of the class
    inside = np.where(class_of < n_words, 0.0, log_of - np.concatenate([np.zeros(n_words), end_total])[class_of])
    ln10 = float(np.log(10.0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ta, tb, tz = tables.value
        numbers = Classes(head_words, endings)

        def scored(rows: pa.RecordBatch, texts: list[list[bytes]]) -> pa.RecordBatch:
            sizes = np.array([len(t) for t in texts])
            ends, tokens = np.cumsum(sizes), list(chain.from_iterable(texts))
            begin, last = ends - sizes, np.zeros(len(tokens), bool)
            last[ends - 1] = True
            number = numbers.of(tokens)
            ids, is_rare = class_of[number], number >= len(head_words)
            c2, c1 = _contexts(ids, last, start)
            model_log = ta[c1, ids] + tb[c2, ids] - tz[c1, c2]
            lm = np.add.reduceat(model_log, begin, dtype=np.float64) / ln10 + np.add.reduceat(inside[number], begin)
            places = np.flatnonzero(is_rare)
            n_rare = np.add.reduceat(is_rare, begin, dtype=np.int64)
            rare = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n_rare)), pa.int32()),
                                            pa.array([tokens[i] for i in places.tolist()], pa.binary()))
            return pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), rows.column(2), pa.array(sizes, pa.int64()),
                 pa.array(sizes - n_rare, pa.int64()),
                 pa.array(np.add.reduceat(log_of[number], begin) - sizes * base_total, pa.float64()),
                 pa.array(lm, pa.float64()), rare],
                names=["doc_id", "text_key", "held_out", "n_tokens", "n_head", "base", "lm", "rare"])

        for rb in _slices(batches):
            held, n, at = [], 0, 0
            for i, t in enumerate(rb.column(3)):
                held.append(tokens_of(t.as_py()))
                n += len(held[-1])
                if n >= _SCORE or i == rb.num_rows - 1:
                    yield scored(rb.slice(at, len(held)), held)
                    held, n, at = [], 0, i + 1

    kind = src.schema["doc_id"].dataType.simpleString()
    scored = materialise(src.mapInArrow(run, f"doc_id {kind}, text_key bigint, held_out boolean, n_tokens bigint, "
                                             "n_head bigint, base double, lm double, rare array<binary>"), "lm-scored")
    key = ["doc_id", "text_key"]
    rare = scored.select(*key, F.explode("rare").alias("token"))
    c = F.coalesce("c", F.lit(0))
    # repeated rows list the same tokens; their sums are divided among them
    tail = (rare.join(counts, "token", "left").groupBy(*key)
            .agg(F.sum(F.log10(c + ALPHA)).alias("tail_log"), F.sum((c > 0).cast("long")).alias("tail_known")))
    rows = scored.groupBy(*key).agg(F.count("*").alias("n_rows"))
    tail = (tail.join(rows, tail["doc_id"].eqNullSafe(rows["doc_id"]) & (tail["text_key"] == rows["text_key"]))
            .select(tail["doc_id"].alias("tid"), tail["text_key"].alias("ttk"),
                    (F.col("tail_log") / F.col("n_rows")).alias("tail_log"),
                    (F.col("tail_known") / F.col("n_rows")).cast("long").alias("tail_known")))
    out = scored.drop("rare").join(tail, F.col("doc_id").eqNullSafe(F.col("tid")) & (F.col("text_key") == F.col("ttk")),
                                   "left")
    tail_log = F.coalesce("tail_log", F.lit(0.0))
    return out.select("doc_id", "held_out", "n_tokens",
                      (F.col("n_head") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
                      F.lit(int(n_all)).cast("long").alias("train_tokens"),
                      (F.col("base") + tail_log).alias("base_score"), (F.col("lm") + tail_log).alias("score"))
