"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight per hashed text feature is shared by all grades; ordered thresholds t0 < t1
split the score f into grades: P(grade <= k) = sigmoid(t_k - f).  The model is fitted on
the driver from a sample of labelled rows that is bounded by the parameter `sample`;
every document is then scored in one Arrow pass with a weight table of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernel as K

BITS = 18
SAMPLE = 12000
#: features of fewer sampled documents get no weight
LEAST = 8
GRADES = 3
#: a document is selected if P(grade = best) reaches this
TAIL = 0.5

_HIGH = K.U64(64 - BITS)


def featurize(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(offsets, index, value) of each row's hashed features.

    Features are the lower-cased words, the last two bytes of each word, and whether a word
    repeats the one before; each has the square root of its share of the row's words.
    """
    offsets, index, value = [0], [], []
    for _, _, raw, at in K.blocks(column):
        starts, ends, words = K.word_spans(raw, at)
        h = K.hash_words(raw, starts, ends, lower=True)
        tail = raw[ends - 1].astype(np.uint64) | raw[np.maximum(ends - 2, starts)].astype(np.uint64) << K.U64(8) if len(ends) else h
        again = np.zeros(len(h), dtype=np.uint64)
        rows = np.repeat(np.arange(len(at) - 1, dtype=np.uint64), np.diff(words))
        # the first word of a text repeats none
        again[1:] = (h[1:] == h[:-1]) & (rows[1:] == rows[:-1])
        slots = [h >> _HIGH, K.mix64(tail + K.U64(1 << 20)) >> _HIGH, K.mix64(again + K.U64(1 << 40)) >> _HIGH]
        key = np.concatenate([(rows << K.U64(BITS)) | s for s in slots])
        key, count = np.unique(key, return_counts=True)
        owner = (key >> K.U64(BITS)).astype(np.int64)
        n = np.diff(words)
        index.append((key & K.U64((1 << BITS) - 1)).astype(np.int32))
        value.append(np.sqrt(count / n[owner]).astype(np.float32))
        offsets += (offsets[-1] + np.searchsorted(owner, np.arange(1, len(at)))).tolist()
    cat = lambda xs, t: np.concatenate(xs) if xs else np.zeros(0, t)
    return np.array(offsets, dtype=np.int64), cat(index, np.int32), cat(value, np.float32)


def _scores(offsets: np.ndarray, index: np.ndarray, value: np.ndarray, weights: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0.0], np.cumsum(weights[index] * value)])
    return run[offsets[1:]] - run[offsets[:-1]]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Ordinal:
    """weights and thresholds of a fitted model."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    @classmethod
    def fit(cls, offsets: np.ndarray, index: np.ndarray, value: np.ndarray, grades: np.ndarray, l2: float = 1e-5, steps: int = 150, rate: float = 0.3) -> Ordinal:
        """Full-batch Adam on the mean log loss; thresholds are a start and positive gaps."""
        n, k = len(grades), GRADES - 1
        w, w1, w2 = (np.zeros(1 << BITS) for _ in range(3))
        c, c1, c2 = np.array([-1.0] + [0.0] * (k - 1)), np.zeros(k), np.zeros(k)
        row = np.repeat(np.arange(n), np.diff(offsets))
        for step in range(1, steps + 1):
            t = c[0] + np.concatenate([[0.0], np.cumsum(np.exp(c[1:]))])
            f = _scores(offsets, index, value, w)
            edge = np.concatenate([np.zeros((n, 1)), _sigmoid(t[None, :] - f[:, None]), np.ones((n, 1))], axis=1)
            slope = edge * (1 - edge)
            p = np.maximum(edge[np.arange(n), grades + 1] - edge[np.arange(n), grades], 1e-12)
            up, low = slope[np.arange(n), grades + 1], slope[np.arange(n), grades]
            df = (up - low) / p / n  # of the loss
            dt = np.zeros(k + 2)
            np.add.at(dt, grades + 1, -up / p / n)
            np.add.at(dt, grades, low / p / n)
            dt = dt[1:-1]
            gw = np.bincount(index, weights=value * df[row], minlength=1 << BITS) + l2 * w
            gc = np.array([dt.sum()] + [dt[j:].sum() * np.exp(c[j]) for j in range(1, k)])
            for x, g, m, v in ((w, gw, w1, w2), (c, gc, c1, c2)):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        return cls(w, c[0] + np.concatenate([[0.0], np.cumsum(np.exp(c[1:]))]))

    def grade(self, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected grade, and probability of the best grade."""
        above = 1 - _sigmoid(self.thresholds[None, :] - scores[:, None])
        return above.sum(axis=1), above[:, -1]


def graded(labels: DataFrame, key: str = "doc_id", quality: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(id, grade): 0 toxic, 1 of low quality, 2 good; several ratings of one id: the worst. Null ids and ratings are left out."""
    grade = F.when(F.col(toxic) == 1, 0).when(F.col(quality) == 0, 1).when((F.col(quality) == 1) & (F.col(toxic) == 0), 2)
    rated = labels.select(F.col(key).cast("long").alias("id"), grade.alias("grade")).where("id is not null and grade is not null")
    return rated.groupBy("id").agg(F.min("grade").alias("grade"))


def trained(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Ordinal | None:
    """Fitted on the labelled rows that come first by a hash of their id, `sample` at most; None if there are none.

    What reaches the driver is bounded by `sample`: the features of so many documents.
    """
    chosen = graded(labels, key).orderBy(F.xxhash64("id", F.lit("grade")), "id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, index, value = featurize(batch.column(1))
            cut = lambda x: pa.array([x[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), cut(index), cut(value)], ["id", "grade", "i", "v"])

    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text")).join(F.broadcast(chosen), "id")  # `sample` rows at most
    got = rows.select("id", "text", "grade").mapInArrow(run, "id long, grade int, i binary, v binary").toArrow().sort_by("id")
    if not got.num_rows:
        return None
    index = [np.frombuffer(x.as_buffer(), np.int32) for x in got["i"]]
    value = [np.frombuffer(x.as_buffer(), np.float32) for x in got["v"]]
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in index])])
    index, value = np.concatenate(index), np.concatenate(value)
    known = np.bincount(index, minlength=1 << BITS)[index] >= LEAST
    left = np.concatenate([[0], np.cumsum(known)])
    return Ordinal.fit(left[offsets], index[known], value[known], got["grade"].to_numpy().astype(np.int64))


def classified(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", sample: int = SAMPLE, tail: float = TAIL) -> DataFrame:
    """One row per input row: doc_id, expected_grade (0 to 2), p_best (probability of grade 2) and kept (p_best >= tail).

    A null or wordless text has no features and gets the probability that the thresholds alone
    give.  Without any labelled row the model is undefined: expected_grade and p_best are
    null and kept is true.  Labels of unknown ids are ignored.  Null ids and repeated rows are
    rows like others.  Other columns are not read.  No rows give no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    model = trained(docs, labels, key, text, sample)
    if model is None:
        return rows.select("doc_id", F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("p_best"), F.lit(True).alias("kept"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grade, best = shared.value.grade(_scores(*featurize(batch.column(1)), shared.value.weights))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(grade), pa.array(best), pa.array(best >= tail)], ["doc_id", "expected_grade", "p_best", "kept"])

    return rows.mapInArrow(run, "doc_id long, expected_grade double, p_best double, kept boolean")
