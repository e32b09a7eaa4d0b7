"""Quality classifier: a factorisation machine (operator 9).

Features of a text are its hashed words, binned structure statistics and binned
lengths. Each feature i has a weight and a short vector; all pairs interact by
the dot products of their vectors, and the sum over pairs is taken in linear
time as half of (sum of vectors)^2 minus (sum of squared vectors), per
dimension. The model is trained by AdaGrad on at most ``SAMPLE`` labelled
documents (those with the smallest hash of their id); every document is then
scored from its whole text.

Edge cases: null and empty texts have only structure features and get a score
too; labels without a document, and null labels, are left out; if no labelled
document remains, every score is 0.5; repeated rows are scored alike. Ids, language, source
and labels are never features. A null id counts as not held out.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from pageflow.llm.scan import list_column, map_texts, with_columns

SAMPLE = 6000
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
WORD_BUCKETS = 1 << 15
BINS = 12
FACTORS = 6
EPOCHS, BATCH, RATE, DECAY = 6, 128, 0.08, 1e-5
SEED = 7

_UPPER, _DIGIT, _STOP, _SYMBOL, _SPACE, _LINE, _WIDE = range(1, 8)


def _byte_kinds() -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[65:91], table[48:58], table[0xC0:] = _UPPER, _DIGIT, _WIDE
    table[list(b".,;:!?'\"()-")], table[list(b"#*$%&|<>~^=+@_{}[]\\/")] = _STOP, _SYMBOL
    table[[9, 11, 12, 13, 32]], table[10] = _SPACE, _LINE
    return table


_KINDS = _byte_kinds()
STATISTICS = 14
SIZE = WORD_BUCKETS + STATISTICS * BINS


def extract(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(feature indices, values) of a whole text; the values of the words have length 1 in all."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    n, size = len(words), max(1, len(data))
    kinds = np.bincount(_KINDS[np.frombuffer(data, np.uint8)], minlength=8) / size
    hashed = np.fromiter(map(zlib.crc32, words), np.int64, n)
    distinct, counts = np.unique(hashed, return_counts=True)
    same = float((hashed[1:] == hashed[:-1]).mean()) if n > 1 else 0.0
    lines = data.split(b"\n")
    ends = sum(x.rstrip().endswith((b".", b"!", b"?")) for x in lines) / len(lines)
    share = [*kinds[_UPPER:_LINE + 1] * [1, 1, 1, 1, 1, 4], same, ends,
             len(distinct) / max(1, n), counts.max() / n if n else 0.0, kinds[_WIDE],
             min(1.0, len(data) / max(1, n) / 24), min(1.0, np.log1p(n) / 12), min(1.0, np.log1p(n / len(lines)) / 8)]
    # square roots spread the small shares over the bins
    bins = np.minimum(BINS - 1, (np.sqrt(np.clip(share, 0, 1)) * BINS).astype(np.int64))
    stats = WORD_BUCKETS + np.arange(STATISTICS) * BINS + bins
    buckets, inverse = np.unique(distinct % WORD_BUCKETS, return_inverse=True)
    weights = np.sqrt(np.bincount(inverse, counts, minlength=len(buckets)))
    weights /= max(1e-9, np.sqrt((weights ** 2).sum()))
    return np.concatenate([buckets, stats]), np.concatenate([weights, np.full(STATISTICS, 0.5)])


@dataclass
class FactorisationMachine:
    bias: float
    weights: np.ndarray
    vectors: np.ndarray

    def raw(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Scores before the sigmoid of rows stored one after the other, row r from ``starts[r]``."""
        vx = self.vectors[index] * value[:, None]
        linear = np.add.reduceat(self.weights[index] * value, starts)
        sums = np.add.reduceat(vx, starts, axis=0)
        squares = np.add.reduceat(vx * vx, starts, axis=0)
        return self.bias + linear + 0.5 * (sums * sums - squares).sum(axis=1)

    def score(self, index: np.ndarray, value: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(index, value, starts), -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray) -> FactorisationMachine:
    """AdaGrad on the log loss."""
    rng = np.random.default_rng(SEED)
    model = FactorisationMachine(0.0, np.zeros(SIZE), rng.normal(0, 0.02, (SIZE, FACTORS)))
    if not len(rows):
        model.vectors[:] = 0
        return model
    gw, gv = np.full(SIZE, 1e-3), np.full((SIZE, FACTORS), 1e-3)
    gb = 1e-3
    for _ in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            part = order[at:at + BATCH]
            index = np.concatenate([rows[i][0] for i in part])
            value = np.concatenate([rows[i][1] for i in part])
            sizes = np.array([len(rows[i][0]) for i in part])
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            error = (model.score(index, value, starts) - labels[part]) / len(part)
            row = np.repeat(np.arange(len(part)), sizes)
            sums = np.add.reduceat(model.vectors[index] * value[:, None], starts, axis=0)
            slope = error[row] * value
            touched, inverse = np.unique(index, return_inverse=True)
            dw = np.bincount(inverse, slope, len(touched)) + DECAY * model.weights[touched]
            pull = slope[:, None] * (sums[row] - model.vectors[index] * value[:, None])
            dv = np.stack([np.bincount(inverse, pull[:, f], len(touched)) for f in range(FACTORS)], axis=1)
            dv += DECAY * model.vectors[touched]
            gw[touched] += dw * dw
            gv[touched] += dv * dv
            gb += error.sum() ** 2
            model.weights[touched] -= RATE * dw / np.sqrt(gw[touched])
            model.vectors[touched] -= RATE * dv / np.sqrt(gv[touched])
            model.bias -= RATE * error.sum() / np.sqrt(gb)
    return model


def held_out(id_col: str = "doc_id"):
    """The fold that labels are never learned from."""
    fold = F.crc32(F.col(f"`{id_col}`").cast("string")) % FOLDS
    return F.coalesce(fold == HELD_OUT, F.lit(False))


def _extracted(docs: DataFrame, extra: dict) -> DataFrame:
    """The columns ``extra`` with the features of each text as two arrays."""

    def run(batches):
        for b in batches:
            found = [extract(t) for t in b.column("text").to_pylist()]
            ends = np.cumsum([len(i) for i, _ in found])
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], list_column(np.concatenate([i for i, _ in found]).astype(np.int32), ends, pa.int32()),
                 list_column(np.concatenate([v for _, v in found]), ends, pa.float64())],
                [*b.schema.names[:-1], "index", "value"])

    kinds = ", ".join(f"{k} long" for k in extra if k != "text")
    return map_texts(docs, extra, f"{kinds}, index array<int>, value array<double>", run)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id",
          text_col: str = "text", sample: int = SAMPLE) -> FactorisationMachine:
    """Fits on at most ``sample`` labelled documents outside the held-out fold (their features come to the driver)."""
    known = (labels.where(F.col(label_col).isin(0, 1) & ~held_out(id_col))
             .select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(label_col).cast("long").alias("label"))
             .groupBy("doc_id").agg(F.min("label").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample).collect())
    if not known:
        return fit([], np.zeros(0))
    wanted = docs.sparkSession.createDataFrame(known, "w_id long, label long")
    joined = (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
              .join(F.broadcast(wanted), F.col("doc_id") == F.col("w_id")))  # at most ``sample`` narrow rows
    found = _extracted(joined, {"doc_id": "doc_id", "label": "label", "text": "text"}).dropDuplicates(["doc_id"]).toArrow()
    order = np.argsort(found.column("doc_id").to_numpy())
    index, value = (found.column(c).combine_chunks() for c in ("index", "value"))
    rows = [(index[int(k)].values.to_numpy().astype(np.int64), value[int(k)].values.to_numpy()) for k in order]
    return fit(rows, found.column("label").to_numpy()[order].astype(float))


def score(docs: DataFrame, model: FactorisationMachine, keep: list[str], text_col: str = "text",
          name: str = "score") -> DataFrame:
    """The columns ``keep`` of every document and its score, called ``name``. The model has a fixed size."""
    sent = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights, model.vectors))

    def scores(texts):
        found = [extract(t) for t in texts]
        starts = np.concatenate([[0], np.cumsum([len(i) for i, _ in found])[:-1]]).astype(np.int64)
        index, value = (np.concatenate(x) for x in zip(*found))
        return [pa.array(FactorisationMachine(*sent.value).score(index, value, starts))]

    return with_columns(docs, keep, text_col, [StructField(name, DoubleType())], scores)
