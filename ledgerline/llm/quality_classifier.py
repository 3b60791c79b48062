"""Quality classifier: random Fourier features and ridge regression.

A document becomes a short vector of statistics (lengths, character classes,
repetition of words and lines).  Random Fourier features of the standardised
statistics approximate a Gaussian kernel.  Each partition sums its part of the
normal equations, Spark adds the parts, and the driver solves one small ridge
system.  Isotonic regression on the training scores turns raw scores into
probabilities.

All labelled training rows are used; nothing that reaches the driver grows
with them: column means, one (D+1) x (D+1) matrix and at most 1000 score bins.
Only the text enters a score.

Defined cases: null text is empty, and empty texts are scored like any other;
labels that are null or have a null doc_id are left out; several labels of one
document all count; without any training label each score is 0.5; repeated
rows each return a row; extra columns are ignored; empty tables give an empty
result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.calibration import isotonic_apply, isotonic_from_frame
from ledgerline.llm.common import crc_mod, materialise, text_of

FEATURES = 192
RIDGE = 1e-3
SEED = 11
_LOWER, _UPPER = bytes(range(97, 123)), bytes(range(65, 91))
_DIGIT, _SPACE, _STOP = b"0123456789", b" \t\n\r\x0b\x0c", b".,;:'\"()?-"
_HIGH = bytes(range(128, 256))
_ALNUM_HIGH = _LOWER + _UPPER + _DIGIT + _SPACE + _STOP + _HIGH
N_STATS = 17


def statistics(text: bytes) -> list[float]:
    """Statistics of one UTF-8 text; shares are of its bytes, words or lines."""
    n = len(text)
    size = max(n, 1)
    words = text.split()
    count = max(len(words), 1)
    seen = Counter(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    per_line = max(len(lines), 1)
    top = max(seen.values(), default=0)

    def share(chars: bytes) -> float:
        return (n - len(text.translate(None, chars))) / size

    again = sum(a == b for a, b in zip(words, words[1:])) / count
    symbols = len(text.translate(None, _ALNUM_HIGH)) / size
    capital = sum(w[:1].isupper() for w in words) / count
    one = sum(len(w) == 1 for w in words) / count
    return [np.log1p(len(words)), np.log1p(n / per_line), n / count, share(_LOWER), share(_UPPER), share(_DIGIT),
            share(_SPACE), share(_STOP), share(_HIGH), symbols, text.count(b"|") / count, text.count(b"!") / count,
            len(seen) / count ** 0.9, top / count, 1 - len(set(lines)) / per_line if lines else 0.0, again,
            one + capital]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x array<float>) per row."""
    src = docs.select(F.col(id_col).alias("doc_id"), text_of(F.col(text_col)).cast("binary").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = [statistics(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(x, pa.list_(pa.float32()))], names=["doc_id", "x"])

    return src.mapInArrow(run, f"doc_id {src.schema['doc_id'].dataType.simpleString()}, x array<float>")


class FourierMap:
    """Standardise, then sqrt(2/D) cos(xW + b) with a constant added."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, features: int, seed: int):
        rng = np.random.default_rng(seed)
        d = len(mean)
        self.mean, self.std = mean, np.where(std > 1e-9, std, 1.0)
        self.w = rng.normal(0.0, 1.0 / np.sqrt(d), (d, features))
        self.b = rng.uniform(0.0, 2 * np.pi, features)
        self.scale = np.sqrt(2.0 / features)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -8.0, 8.0)
        f = self.scale * np.cos(z @ self.w + self.b)
        return np.hstack([f, np.ones((len(f), 1))])


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.to_pylist(), np.float64).reshape(len(column), -1)


def normal_equations(train: DataFrame, fmap: FourierMap) -> tuple[np.ndarray, np.ndarray]:
    """Z'Z and Z'y over all rows of (x, label): partial sums per partition,
    row i of the matrix with its right-hand side as one Spark row, added up by
    Spark per i."""
    size = len(fmap.b) + 1

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        rows = 0
        for b in batches:
            if b.num_rows:
                z, y = fmap(_matrix(b.column(0))), np.asarray(b.column(1).to_pylist(), np.float64)
                total += z.T @ np.column_stack([z, y])
                rows += b.num_rows
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()),
                                              pa.array(list(total), pa.list_(pa.float64()))], names=["i", "v"])

    parts = train.select("x", "label").mapInArrow(part, "i int, v array<double>")
    at = [F.sum(F.col("v")[j]).alias(f"c{j}") for j in range(size + 1)]
    rows = sorted((r for r in parts.groupBy("i").agg(F.array(*at).alias("v")).collect()), key=lambda r: r["i"])
    if not rows:
        return np.eye(size), np.zeros(size)
    total = np.array([r["v"] for r in rows])
    return total[:, :size], total[:, size]


def train_and_score(docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 5,
                    held_out_fold: int = 0, features: int = FEATURES, ridge: float = RIDGE, seed: int = SEED,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, raw, score) per row of ``docs``, learning from the
    labelled rows outside the held-out fold."""
    stats = materialise(document_statistics(docs, id_col, text_col), "quality-stats")
    known = (labels.select(F.col(id_col).alias("lid"), F.col(label_col).cast("int").alias("label"))
             .filter(F.col("label").isNotNull() & F.col("lid").isNotNull()
                     & (crc_mod(F.col("lid"), folds) != held_out_fold)))
    train = materialise(stats.join(known, F.col("doc_id") == F.col("lid")).select("x", "label"), "quality-train")
    first = train.agg(F.count("*"), *[f(F.col("x")[i].cast("double")) for i in range(N_STATS)
                                      for f in (F.avg, F.stddev_pop)]).first()
    kind = stats.schema["doc_id"].dataType.simpleString()
    if not first[0]:
        return stats.select("doc_id", (crc_mod(F.col("doc_id"), folds) == held_out_fold).alias("held_out"),
                            F.lit(0.5).alias("raw"), F.lit(0.5).alias("score"))
    moments = np.array(first[1:], np.float64)
    fmap = FourierMap(moments[0::2], moments[1::2], features, seed)
    zz, zy = normal_equations(train, fmap)
    beta = np.linalg.solve(zz + ridge * first[0] * np.eye(len(zz)) / features, zy)

    def raw(columns: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                got = fmap(_matrix(b.column(1))) @ beta if b.num_rows else np.zeros(0)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.float64())], names=columns.split())
        return run

    on_train = train.select("label", "x").mapInArrow(raw("label raw"), "label int, raw double")
    knots = isotonic_from_frame(on_train)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in raw("doc_id raw")(batches):
            p = isotonic_apply(knots, np.asarray(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(p, pa.float64())],
                                             names=["doc_id", "raw", "score"])

    out = stats.mapInArrow(score, f"doc_id {kind}, raw double, score double")
    return out.select("doc_id", (crc_mod(F.col("doc_id"), folds) == held_out_fold).alias("held_out"), "raw", "score")
