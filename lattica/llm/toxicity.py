"""Toxicity by class-conditional Kneser-Ney models.

Two bigram models are fitted on labelled texts, one on toxic, one on ordinary
ones. Expressions (a word after another, or after the start) count once a document,
so that one text full of repeats is no evidence. For each class

* P(v | w) = max(c(w v) - D, 0) / c(w) + backoff(w) P(v), c being documents of the class,
* P(v) = max(N(v) - E, 0) / N + backoff P'(v), N(v) being the distinct words before v in the class,
* P'(v), shared by both classes, is in proportion to the distinct words before v in either, and half a one more.

D and E come from the counts of counts. So what is rare in the labelled texts gets
nearly equal probability in both. Pairs found in fewer than `min_pair` documents
leave their mass to the backoff (a cutoff; README: held-out figures without it).

A toxic text is ordinary but for some expressions, so its likelihood is that of a
mixture, 1 - mix ordinary and mix toxic; the difference of the log-likelihoods
over the number of words is turned into a probability by a logistic curve that is
fitted on labelled rows held back from the counts.

The models are fitted on at most `max_rows` labelled rows, chosen by a hash of
the id; scoring covers all rows. Null and empty texts have no words and get the
score of a difference of zero. Without labels of both classes every text gets the
score 0 or the share of toxic labels. Repeated rows are scored each; an empty
table gives an empty table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import fold, map_arrow, map_batches, staged, texts_of
from lattica.llm.sampling import labelled

MAX_ROWS, MIN_PAIR, MIX = 12_000, 6, 0.01
_FLUSH = 300_000
_STRIP = ".,;:!?\"'()[]…«»"


def words_of(text: str) -> list[str]:
    """Lower-cased words without punctuation around them."""
    return [w for x in text.lower().split() if (w := x.strip(_STRIP))]


def discount(n1: int, n2: int) -> float:
    """The absolute discount that fits n1 types seen once and n2 seen twice."""
    return n1 / (n1 + 2 * n2) if n1 + n2 else 0.5


class ToxicityModel:
    """Log-ratios by word, by pair of words and by head, and the logistic curve."""

    def __init__(self, contexts: dict[str, tuple[int, int, int]], heads: dict[str, tuple[int, int]], pairs: dict[tuple[str, str], tuple[int, int]], pair_discounts: tuple[float, float], docs: tuple[int, int], mix: float = MIX) -> None:
        """contexts: distinct words before each word, in ordinary, toxic and all texts; heads: pairs of each head; pairs: those kept; docs: labelled texts."""
        self.mix, self.curve, self.docs = mix, (0.0, -20.0), docs
        names = list(contexts)
        n = np.array(list(contexts.values()), dtype=np.float64).reshape(-1, 3)
        shared = (n[:, 2] + 0.5) / (n[:, 2].sum() + 0.5 * (len(n) + 1))
        p, free = [], []
        for k in (0, 1):
            e = discount(int((n[:, k] == 1).sum()), int((n[:, k] == 2).sum()))
            total = max(1.0, n[:, k].sum())
            free.append(max(np.minimum(n[:, k], e).sum() / total, 1e-6) if n[:, k].any() else 1.0)
            p.append(np.maximum(n[:, k] - e, 0) / total + free[k] * shared)
        self.word = dict(zip(names, np.log(p[1] / p[0]).tolist()))
        self.unseen = math.log(free[1] / free[0])
        at = {w: i for i, w in enumerate(names)}
        seen = {w: [0.0, 0.0] for w, _ in pairs}
        for (w, _), c in pairs.items():
            for k in (0, 1):
                seen[w][k] += max(c[k] - pair_discounts[k], 0)
        back = {w: [1 - x[k] / heads[w][k] if heads[w][k] else 1.0 for k in (0, 1)] for w, x in seen.items()}
        self.head = {w: math.log(max(x[1], 1e-6) / max(x[0], 1e-6)) for w, x in back.items()}
        self.pair = {}
        for (w, v), c in pairs.items():
            q = [max(c[k] - pair_discounts[k], 0) / max(1, heads[w][k]) + back[w][k] * p[k][at[v]] for k in (0, 1)]
            self.pair[w, v] = math.log(q[1] / q[0])

    def differences(self, words: list[str]) -> np.ndarray:
        """ln P(word | word before, toxic) - ln P(word | word before, ordinary) of each word."""
        get, unseen, head = self.word.get, self.unseen, self.head
        x = np.fromiter((get(w, unseen) for w in words), dtype=np.float64, count=len(words))
        for i, h in enumerate(["", *words[:-1]]):
            if h in head:
                both = self.pair.get((h, words[i]))
                x[i] = x[i] + head[h] if both is None else both
        return x

    def ratio(self, text: str) -> float:
        """The length-normalised difference of the log-likelihoods."""
        words = words_of(text)
        return float(np.log1p(self.mix * np.expm1(np.minimum(self.differences(words), 50))).mean()) if words else 0.0

    def score(self, text: str) -> float:
        a, b = self.curve
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, a * self.ratio(text) + b))))

    def calibrate(self, ratios: np.ndarray, toxic: np.ndarray) -> None:
        """Newton's method for the logistic curve, with a little ridge."""
        if not len(toxic) or toxic.min() == toxic.max():
            share = (self.docs[1]) / max(1, sum(self.docs))
            self.curve = (0.0, math.log(max(share, 1e-9) / max(1 - share, 1e-9)))
            return
        scale = ratios.std() or 1.0
        X = np.c_[np.clip(ratios / scale, -3, 3), np.ones(len(ratios))]
        w = np.zeros(2)
        for _ in range(100):
            p = 1 / (1 + np.exp(-X @ w))
            h = X.T @ (X * (p * (1 - p))[:, None]) + 1e-3 * np.eye(2)
            step = np.linalg.solve(h, X.T @ (toxic - p) - 1e-3 * w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        self.curve = (float(w[0] / scale), float(w[1]))


def expression_counts(train: DataFrame) -> DataFrame:
    """(w, v, ordinary, toxic): documents of each class with word v after word w; w is '' at the start."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flushed() -> Iterator[pa.RecordBatch]:
            keys = list(counts[0].keys() | counts[1].keys())
            for i in range(0, len(keys), 50_000):
                part = keys[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in part], pa.string()), pa.array([k[1] for k in part], pa.string()), pa.array([counts[0][k] for k in part], pa.int64()), pa.array([counts[1][k] for k in part], pa.int64())], names=["w", "v", "ordinary", "toxic"])
            for c in counts:
                c.clear()

        for batch in batches:
            for t, y in zip(texts_of(batch), batch.column("_label").to_pylist()):
                words = words_of(t)
                counts[y > 0].update(set(zip(["", *words], words)))
                if len(counts[0]) + len(counts[1]) > _FLUSH:
                    yield from flushed()
        yield from flushed()

    return map_arrow(train.select("text", "_label"), run, "w string, v string, ordinary long, toxic long").groupBy("w", "v").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


def train(docs: DataFrame, labels: DataFrame, is_train: Column, is_held_back: Column, id_col: str = "doc_id", text_col: str = "text", label: str = "toxic", max_rows: int = MAX_ROWS, mix: float = MIX, min_pair: int = MIN_PAIR) -> ToxicityModel:
    """The model of the labelled rows that are in training; those held back fit its curve. All that is fetched is bounded by max_rows documents."""
    rows = labelled(docs, labels, F.col(label), is_train, max_rows, id_col, text_col)
    counted = staged(expression_counts(rows.where(~is_held_back)), "expressions")

    def fetched(df: DataFrame) -> list[tuple]:
        return list(zip(*(c.to_pylist() for c in df.toArrow().columns)))

    contexts = {v: n for v, *n in fetched(counted.groupBy("v").agg(F.count_if(F.col("ordinary") > 0), F.count_if(F.col("toxic") > 0), F.count(F.lit(1))))}
    kept = counted.where(F.col("ordinary") + F.col("toxic") >= min_pair)
    pairs = {(w, v): (a, b) for w, v, a, b in fetched(kept)}
    largest = F.max(F.col("ordinary") + F.col("toxic"))
    heads = {w: (a, b) for w, a, b, _ in fetched(counted.groupBy("w").agg(F.sum("ordinary"), F.sum("toxic"), largest.alias("largest")).where(F.col("largest") >= min_pair))}
    once = fetched(counted.agg(*[F.count_if(F.col(c) == n) for c in ("ordinary", "toxic") for n in (1, 2)]))[0]
    y = [0, 0]
    for r in rows.where(~is_held_back).groupBy((F.col("_label") > 0).cast("int").alias("y")).count().collect():
        y[r["y"]] = r["count"]
    model = ToxicityModel(contexts, heads, pairs, (discount(*once[:2]), discount(*once[2:])), (y[0], y[1]), mix)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def ratios(batch: pa.RecordBatch) -> dict:
        return {"x": [shared.value.ratio(t) for t in texts_of(batch)], "y": [int(v > 0) for v in batch.column("_label").to_pylist()]}

    back = map_batches(rows.where(is_held_back).select("text", "_label"), ratios, "x double, y int").collect()  # at most max_rows pairs
    model.calibrate(np.array([r.x for r in back]), np.array([r.y for r in back]))
    return model


def score(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, score) of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    df = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def scored(batch: pa.RecordBatch) -> dict:
        return {"id": batch.column("id"), "score": [shared.value.score(t) for t in texts_of(batch)]}

    return map_batches(df, scored, f"id {df.schema['id'].dataType.simpleString()}, score double").withColumnRenamed("id", id_col)


def toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, max_rows: int = MAX_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted): rows of fold 0 are held out; fold 1 fits the curve, the others the counts."""
    at = fold(F.col("doc_id"), folds)
    model = train(docs, labels, at != 0, at == 1, max_rows=max_rows)
    return score(docs, model).select("doc_id", (at == 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
