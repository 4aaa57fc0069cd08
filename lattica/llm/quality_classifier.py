"""Quality classifier: ordinal cumulative-link regression on graded ratings.

A text has hashed features: its words, the shapes of its words, and how repetitive
and how long-lined it is, each in a bucket. One weight vector, shared by all
grades, gives a text's quality; ordered thresholds cut it into grades:
P(grade <= k) = logistic(threshold[k] - quality). The model gives the expected
grade and the probability of the tail from a grade up, by which texts are chosen.
The labels' marks give three grades: 0 bad, 1 good but toxic, 2 good; a document is
kept by the probability of grade 1 or more, so toxic ones of good quality aren't
rejected here. With two grades it is logistic regression.

It is fitted on at most `max_rows` labelled rows, chosen by a hash of the id;
scoring covers all rows and whole texts. Null and empty texts have only the
feature of being empty. With no labels, or one grade, every text is expected to
have that grade (0 if none) and stays. Repeated rows are scored each; an empty
table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import fold, map_arrow, map_batches, slices, texts_of
from lattica.llm.sampling import labelled

MAX_ROWS, DIMS, STEPS, RIDGE, KEEP, GOOD = 8_000, 1 << 15, 150, 1e-3, 0.35, 1.0

_SHAPE = bytes(0x58 if 65 <= c <= 90 else 0x78 if 97 <= c <= 122 or c >= 128 else 0x39 if 48 <= c <= 57 else c for c in range(256))
_RUN = re.compile(rb"([Xx9])\1+")


def _pieces(sums: Counter, size: int = 64) -> Counter:
    """Names of over `size` bytes, as in unspaced scripts, in consecutive pieces that all count."""
    if max(map(len, sums)) <= size:
        return sums
    out: Counter = Counter()
    for name, n in sums.items():
        for i in range(0, len(name), size):
            out[name[i : i + size]] += n
    return out


def features(text: str, dims: int = DIMS) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    if not words:
        return np.array([zlib.crc32(b"empty") % dims], dtype=np.int32), np.ones(1, dtype=np.float32)
    shapes = Counter(_RUN.sub(rb"\1", raw.translate(_SHAPE)).split())
    counts = Counter(words)
    n, lines = len(words), [x for x in raw.split(b"\n") if x.strip()]
    marks = {
        b"distinct words": min(9, 10 * len(counts) // n),
        b"most frequent": min(9, 10 * counts.most_common(1)[0][1] // n),
        b"repeated lines": min(9, 10 * (len(lines) - len(set(lines))) // len(lines)),
        b"repeated neighbours": min(9, 10 * sum(a == b for a, b in zip(words, words[1:])) // n),
        b"size": n.bit_length(),
    }
    index: dict[int, float] = {}
    for group, sums in ((b"w", counts), (b"s", shapes)):
        sums = _pieces(sums)
        names = list(sums)
        values = np.log1p(np.fromiter(sums.values(), dtype=np.float64, count=len(names)))
        values /= np.sqrt((values**2).sum())
        for name, v in zip(names, values.tolist()):
            k = zlib.crc32(name, group[0]) % dims
            index[k] = index.get(k, 0.0) + v
    for name, bucket in marks.items():
        k = zlib.crc32(b"%s=%d" % (name, bucket)) % dims
        index[k] = index.get(k, 0.0) + 0.5
    return np.fromiter(index, dtype=np.int32, count=len(index)), np.fromiter(index.values(), dtype=np.float32, count=len(index))


class OrdinalModel:
    """Weights, thresholds and the grades they separate."""

    def __init__(self, grades: list[float], weights: np.ndarray, thresholds: np.ndarray) -> None:
        self.grades, self.weights, self.thresholds = grades, weights, thresholds

    def tails(self, quality: np.ndarray) -> np.ndarray:
        """P(grade >= grades[k]) for k from 1 on, a row for each quality."""
        return 1 / (1 + np.exp(-np.clip(quality[:, None] - self.thresholds[None, :], -40, 40)))

    def expected(self, quality: np.ndarray) -> np.ndarray:
        if len(self.grades) < 2:
            return np.full(len(quality), self.grades[0] if self.grades else 0.0)
        return self.grades[0] + self.tails(quality) @ np.diff(self.grades)

    def quality(self, text: str) -> float:
        i, v = features(text, len(self.weights))
        return float(self.weights[i] @ v)


def fit(rows: np.ndarray, index: np.ndarray, values: np.ndarray, grades: list[float], level: np.ndarray, dims: int = DIMS, steps: int = STEPS, ridge: float = RIDGE) -> OrdinalModel:
    """Adam on the mean negative log-likelihood; thresholds are a first one and positive gaps, so they stay ordered.

    rows, index, values: the features in coordinate form; level: each row's place in grades.
    """
    k, n = len(grades), len(level)
    if k < 2:
        return OrdinalModel(grades, np.zeros(dims), np.zeros(max(0, k - 1)))
    w = np.zeros(dims)
    share = np.clip(np.cumsum(np.bincount(level, minlength=k))[:-1] / n, 1e-3, 1 - 1e-3)
    cuts = np.log(share / (1 - share))
    free = np.r_[cuts[0], np.log(np.maximum(np.diff(cuts), 1e-2))]
    params = [w, free]
    m, s = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        theta = free[0] + np.r_[0, np.cumsum(np.exp(free[1:]))]
        z = np.bincount(rows, weights=w[index] * values, minlength=n)
        edge = np.r_[-np.inf, theta, np.inf]
        low, high = edge[level] - z, edge[level + 1] - z
        with np.errstate(over="ignore"):
            f_low, f_high = 1 / (1 + np.exp(-low)), 1 / (1 + np.exp(-high))
        p = np.maximum(f_high - f_low, 1e-12)
        d_low, d_high = f_low * (1 - f_low) / p, f_high * (1 - f_high) / p
        dz = (d_high - d_low) / n  # of the loss
        dw = np.bincount(index, weights=dz[rows] * values, minlength=dims) + ridge * w / max(1, np.sqrt(n))
        d_theta = np.zeros(k - 1)
        np.add.at(d_theta, level[level < k - 1], -d_high[level < k - 1] / n)
        np.add.at(d_theta, level[level > 0] - 1, d_low[level > 0] / n)
        upper = np.cumsum(d_theta[::-1])[::-1]
        d_free = np.r_[upper[0], upper[1:] * np.exp(free[1:])]
        for i, g in enumerate((dw, d_free)):
            m[i] = 0.9 * m[i] + 0.1 * g
            s[i] = 0.99 * s[i] + 0.01 * g * g
            params[i] -= 0.05 * (m[i] / (1 - 0.9**t)) / (np.sqrt(s[i] / (1 - 0.99**t)) + 1e-9)
    return OrdinalModel(grades, w, free[0] + np.r_[0, np.cumsum(np.exp(free[1:]))])


def rating() -> Column:
    """The grade of a label: 0 without quality, 2 with, 1 if it is also marked toxic; null without a mark of quality."""
    return F.when(F.col("quality") > 0, F.when(F.col("toxic") > 0, 1).otherwise(2)).when(F.col("quality").isNotNull(), 0)


def train(docs: DataFrame, labels: DataFrame, is_train: Column, id_col: str = "doc_id", text_col: str = "text", label: Column | None = None, max_rows: int = MAX_ROWS, dims: int = DIMS) -> OrdinalModel:
    """The model of the labelled rows that are in training; label: their grades, by default rating()."""
    rows = labelled(docs, labels, rating() if label is None else label, is_train, max_rows, id_col, text_col).select("text", F.col("_label").cast("double").alias("grade"))

    def sparse(batch: pa.RecordBatch) -> dict:
        both = [features(t, dims) for t in texts_of(batch)]
        return {"i": [a.tobytes() for a, _ in both], "v": [b.tobytes() for _, b in both], "grade": batch.column("grade")}

    got = map_batches(rows, sparse, "i binary, v binary, grade double").toArrow()  # features of at most max_rows texts
    index = [np.frombuffer(x, dtype=np.int32) for x in got["i"].to_pylist()]
    values = [np.frombuffer(x, dtype=np.float32) for x in got["v"].to_pylist()]
    grade = got["grade"].to_numpy()
    grades = sorted(set(grade.tolist()))
    if not index:
        return OrdinalModel(grades, np.zeros(dims), np.zeros(0))
    where = np.repeat(np.arange(len(index)), [len(x) for x in index])
    return fit(where, np.concatenate(index), np.concatenate(values), grades, np.searchsorted(grades, grade), dims)


def _tail(model: OrdinalModel, quality: np.ndarray, grade: float | None) -> np.ndarray:
    """The probability of `grade` (the highest, if None) or more."""
    cut = len(model.grades) - 1 if grade is None else int(np.searchsorted(model.grades, grade))
    return model.tails(quality)[:, cut - 1] if 0 < cut < len(model.grades) else np.full(len(quality), float(cut <= 0))


def _qualities(model: OrdinalModel, batch: pa.RecordBatch, text_col: str) -> np.ndarray:
    return np.array([model.quality(t) for t in texts_of(batch, text_col)])


def score(docs: DataFrame, model: OrdinalModel, id_col: str = "doc_id", text_col: str = "text", grade: float | None = None) -> DataFrame:
    """(id_col, expected_grade, tail) of each row; tail is the probability of `grade` (the highest, if None) or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def scored(batch: pa.RecordBatch) -> dict:
        q = _qualities(shared.value, batch, "text")
        return {"id": batch.column("id"), "expected_grade": shared.value.expected(q), "tail": _tail(shared.value, q, grade)}

    return map_batches(df, scored, f"id {df.schema['id'].dataType.simpleString()}, expected_grade double, tail double").withColumnRenamed("id", id_col)


def graded(docs: DataFrame, labels: DataFrame, folds: int = 5, keep: float = KEEP, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, held_out, expected_grade, tail, kept): fold 0 is held out of training; tail: the probability of GOOD or more."""
    held_out = fold(F.col("doc_id"), folds) == 0
    model = train(docs, labels, ~held_out, max_rows=max_rows)
    return score(docs, model, grade=GOOD).select("doc_id", held_out.alias("held_out"), "expected_grade", "tail", (F.col("tail") >= keep).alias("kept"))


def filtered(docs: DataFrame, labels: DataFrame, folds: int = 5, keep: float = KEEP, max_rows: int = MAX_ROWS) -> DataFrame:
    """The rows of docs whose probability of grade GOOD or more is at least `keep`."""
    held_out = fold(F.col("doc_id"), folds) == 0
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, ~held_out, max_rows=max_rows))

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                yield batch.filter(pa.array(_tail(shared.value, _qualities(shared.value, batch, "text"), GOOD) >= keep))

    return map_arrow(docs, kept, docs.schema)
