"""Language-model scoring by a log-bilinear neural model, trained by noise-contrastive estimation.

Tokens are lower-cased (A-Z) words between ASCII white space, then one end token.
All training documents give the counts of every token. The vocabulary is every
token with at least `least_count` training tokens, so it grows with the corpus.
The model's score of token w after context c is r[c] C . q[w] + b[w]: a vector for
the context, a position matrix, a vector and a bias for the token. Training
maximises the noise-contrastive objective against the unigram noise; as the
follower counts of all training documents are at hand, its expectation is taken
exactly, by matrix products, and not by drawing noise. It has two steps. The `vocab`
most frequent tokens, the end and one class of all other tokens are fitted
together. Then each other token of the vocabulary gets vectors of its own from its
sparse counts of which of those follow it and which it follows; given the first
step's vectors each token is a problem of its own, and they are solved in tasks.
Scores are normalised over the whole vocabulary. A token outside it has the probability of the class times its add-one share of the
class's tokens, one more share being for unseen ones; so a text's score is a true
log-probability.

Token counts grow with the corpus and are never broadcast whole: the vocabulary and
the `head` most frequent ones go to every task, the other tokens of a text meet their counts in a
join on the token.

Null texts are empty: an end token alone. Repeated rows are scored each, and count
each in training. With no training document every count is zero, and the model
is that of the class alone. Ties in frequency go to the smaller token; of tokens of
one frequency all or none are in the head. An empty
table gives an empty table.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.llm.common import map_arrow, staged

VOCAB, HEAD, DIM, NOISE, STEPS = 511, 200_000, 24, 8, 300
ROW_STEPS, PRIOR, WORD_BLOCK, Z_BLOCK = 40, 20.0, 512, 256
_FLUSH, _PAIRS = 300_000, 3_000_000


def tokens(text: str | None) -> list[bytes]:
    """The words of a text in UTF-8; the end token isn't among them."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def token_counts(train: DataFrame) -> DataFrame:
    """(token binary, n long) over the texts of train; a null token is the end token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys: list, values: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(values, pa.int64())], names=["token", "n"])

        counts: Counter = Counter()
        ends = 0
        for batch in batches:
            for t in batch.column("text").to_pylist():
                counts.update(tokens(t))
                ends += 1
                if len(counts) > _FLUSH:
                    yield out(list(counts), list(counts.values()))
                    counts.clear()
        yield out([*counts, None], [*counts.values(), ends])

    return map_arrow(train.select("text"), run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n")).where("n > 0")


def followers(train: DataFrame, index: dict[bytes, int], top: int) -> DataFrame:
    """(side byte, i int, k int, n long): follower counts, sparse, of all words of the index.

    Ids are those of the index, 0 for words outside it, and len(index) + 1 for the end
    token, which also stands before the first. A class is the id up to `top`, top + 1 for
    the end and 0 for all others. Side 0: class k follows class i; 1: class k follows
    word i, for words of class 0; 2: word i, of class 0, follows class k.
    """
    shared = train.sparkSession.sparkContext.broadcast(index)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get, end, size = shared.value.get, len(shared.value) + 1, top + 2
        classes = np.zeros(end + 1, dtype=np.int64)
        classes[: top + 1] = np.arange(top + 1)
        classes[end] = top + 1
        total, held, n_held = np.zeros(size * size, dtype=np.int64), [], 0

        def out(side: np.ndarray, key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(side, pa.int8()), pa.array(key // size, pa.int32()), pa.array(key % size, pa.int32()), pa.array(n, pa.int64())], names=["side", "i", "k", "n"])

        def flushed() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return out(1 + key % 2, key // 2, n)

        for batch in batches:
            for t in batch.column("text").to_pylist():
                words = tokens(t)
                ids = np.fromiter((get(w, 0) for w in words), dtype=np.int64, count=len(words))
                c, w = np.r_[end, ids], np.r_[ids, end]
                kc, kw = classes[c], classes[w]
                np.add.at(total, kc * size + kw, 1)
                a, b = kc == 0, kw == 0
                held += [2 * (c[a] * size + kw[a]), 2 * (w[b] * size + kc[b]) + 1]
                n_held += int(a.sum() + b.sum())
                if n_held > _PAIRS:
                    yield flushed()
                    n_held = 0
        if held:
            yield flushed()
        at = np.flatnonzero(total)
        yield out(np.zeros(len(at)), at, total[at])

    return map_arrow(train.select("text"), run, "side byte, i int, k int, n long").groupBy("side", "i", "k").agg(F.sum("n").alias("n"))


def fit(pairs: np.ndarray, dim: int = DIM, noise: int = NOISE, steps: int = STEPS, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts r C, token vectors q and biases b of the classes, from the follower counts of all pairs of classes.

    Adam on the expected noise-contrastive objective: an observed pair against
    `noise` pairs of the same context with a token of the unigram distribution.
    """
    size = len(pairs)
    rng = np.random.default_rng(seed)
    r, q = rng.normal(0, 0.1, (size, dim)), rng.normal(0, 0.1, (size, dim))
    pos = np.eye(dim)
    unigram = pairs.sum(axis=0) + 0.5
    unigram = unigram / unigram.sum()
    b = np.log(unigram)
    total = max(1.0, pairs.sum())
    seen = pairs / total
    drawn = noise * (pairs.sum(axis=1, keepdims=True) / total) * unigram[None, :]
    offset = np.log(noise * unigram)[None, :]
    params = [r, pos, q, b]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        rc = r @ pos
        s = rc @ q.T + b[None, :] - offset
        data = 1 / (1 + np.exp(-np.clip(s, -40, 40)))
        g = seen * (1 - data) - drawn * data
        grads = [g @ q @ pos.T, r.T @ (g @ q), g.T @ rc, g.sum(axis=0)]
        rate = 0.05 * min(1.0, 3 * (1 - (t - 1) / steps))
        for i, (p, dp) in enumerate(zip(params, grads)):
            m[i] = 0.9 * m[i] + 0.1 * dp
            v[i] = 0.99 * v[i] + 0.01 * dp * dp
            p += rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.99**t)) + 1e-10)
    return r @ pos, q, b


def fit_rows(basis: np.ndarray, fixed: np.ndarray, start: np.ndarray, data: np.ndarray, drawn: np.ndarray, steps: int = ROW_STEPS) -> np.ndarray:
    """For each row i of data the vector x that maximises the expected noise-contrastive objective, all else given.

    The score of (i, k) against noise is basis[k] x[i] + fixed[i, k]; data and drawn
    are how often the pair is seen and drawn as noise. Adam from `start`, to which a
    ridge of PRIOR observations pulls, so rare words stay close to their class.
    """
    x, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    n = data.sum(axis=1, keepdims=True) + PRIOR
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ basis.T + fixed, -40, 40)))
        g = ((data * (1 - p) - drawn * p) @ basis - PRIOR * (x - start)) / n
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        x += 0.2 * (1 - (t - 1) / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return x


def fit_words(pairs: DataFrame, classes: np.ndarray, counts: np.ndarray, parts: tuple[np.ndarray, np.ndarray, np.ndarray], noise: int) -> DataFrame:
    """(side, i, x): the context vector (side 1), or the token vector and then the bias (side 2), of each word of class 0.

    pairs: followers(); classes: the follower counts of the classes; counts: training tokens of each id, the end last.
    Each word's objective needs only its own sparse counts and the classes' vectors; blocks of words are fitted in tasks.
    """
    r, q, b = parts
    unigram = (classes.sum(axis=0) + 0.5) / (classes.sum(axis=0) + 0.5).sum()
    own = (counts + 0.5) / (counts + 0.5).sum()
    shared = pairs.sparkSession.sparkContext.broadcast((r, q, b, unigram, own, classes.sum(axis=1)))

    def fitted(group: pd.DataFrame) -> pd.DataFrame:
        r, q, b, unigram, own, seen = shared.value
        side = int(group["side"].iloc[0])
        ids, at = np.unique(group["i"].to_numpy(), return_inverse=True)
        data = np.zeros((len(ids), len(b)))
        data[at, group["k"].to_numpy()] = group["n"].to_numpy()
        if side == 1:
            drawn = noise * data.sum(axis=1, keepdims=True) * unigram[None, :]
            x = fit_rows(q, np.broadcast_to(b - np.log(noise * unigram), data.shape), np.repeat(r[:1], len(ids), axis=0), data, drawn)
        else:
            u = own[ids][:, None]
            start = np.c_[np.repeat(q[:1], len(ids), axis=0), b[0] - np.log(unigram[0]) + np.log(u)]
            x = fit_rows(np.c_[r, np.ones(len(r))], np.broadcast_to(-np.log(noise * u), data.shape), start, data, noise * u * seen[None, :])
        return pd.DataFrame({"side": np.full(len(ids), side, np.int8), "i": ids.astype(np.int32), "x": list(x)})

    block = F.floor(F.col("i") / WORD_BLOCK)
    return pairs.where("side > 0").withColumn("block", block).groupBy("side", "block").applyInPandas(fitted, "side byte, i int, x array<double>")


def normalisers(spark: SparkSession, r: np.ndarray, q: np.ndarray, b: np.ndarray) -> np.ndarray:
    """ln of the sum of exp(r[c] q[w] + b[w]) over all tokens w, for each context c; blocks of contexts in tasks."""
    shared = spark.sparkContext.broadcast((r, q, b))
    n = len(r)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, q, b = shared.value
        for batch in batches:
            for lo in batch.column("id").to_pylist():
                top, total = np.full(min(n - lo, Z_BLOCK), -np.inf), np.zeros(min(n - lo, Z_BLOCK))
                for at in range(0, n, 16_384):
                    s = r[lo : lo + Z_BLOCK] @ q[at : at + 16_384].T + b[None, at : at + 16_384]
                    new = np.maximum(top, s.max(axis=1))
                    total = total * np.exp(top - new) + np.exp(s - new[:, None].astype(np.float32)).sum(axis=1, dtype=np.float64)
                    top = new
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(lo, lo + len(top))), pa.array(top + np.log(total))], names=["c", "z"])

    blocks = -(-n // Z_BLOCK)
    got = map_arrow(spark.range(0, n, Z_BLOCK, min(blocks, 64)), run, "c long, z double").toArrow()  # a number for each context
    z = np.zeros(n)
    z[got["c"].to_numpy()] = got["z"].to_numpy()
    return z


class Model:
    """What scoring needs of the corpus: totals, head counts, and of each word of the vocabulary its vectors, bias and normaliser."""

    def __init__(self, n: int, distinct: int, ends: int, head: dict[bytes, int], index: dict[bytes, int], parts: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.n, self.distinct, self.ends, self.head, self.index = n, distinct, ends, head, index
        self.r, self.q, self.b, self.z = parts
        known = sum(head[w] for w in index)
        self.rest = (n - ends - known) + (distinct - (ends > 0) - len(index)) + 1  # shares of the class: its tokens, add-one, and one for the unseen

    def log10(self, c: np.ndarray, w: np.ndarray) -> np.ndarray:
        """log10 P(w | c) of pairs of ids."""
        return (np.einsum("ij,ij->i", self.r[c], self.q[w]) + self.b[w] - self.z[c]) / np.log(10)

    @property
    def matrix(self) -> np.ndarray:
        """log10 P(w | c) of all pairs of ids; for small vocabularies."""
        return (self.r @ self.q.T + self.b[None, :] - self.z[:, None]) / np.log(10)


def least_count(n: int) -> int:
    """Training tokens that a word of the vocabulary has at least: it grows with the square root of their number, so the vocabulary grows too."""
    return max(5, math.ceil(math.sqrt(n) / 20))


def head_count(words: DataFrame, most: int) -> int:
    """The least count that at most `most` words have: exact below 1024, then of the form k * 2^j with k of 64 to 127."""
    n = F.col("n")
    step = F.greatest(F.lit(1), F.expr("cast(pow(2, floor(log2(n)) - 6) as bigint)"))
    bins = words.groupBy(F.when(n < 1024, n).otherwise(n - n % step).alias("at")).agg(F.count(F.lit(1)).alias("words"))
    rows = sorted(((r["at"], r["words"]) for r in bins.collect()), reverse=True)  # at most some 5,000
    held, least = 0, (rows[0][0] + 1 if rows else 1)
    for at, more in rows:
        held += more
        if held > most:
            break
        least = at
    return least


def train_model(docs: DataFrame, is_train: Column, text_col: str = "text", vocab: int = VOCAB, head: int = HEAD, dim: int = DIM, noise: int = NOISE, steps: int = STEPS) -> tuple[Model, DataFrame]:
    """The model of the training rows of docs, and the counts of all their tokens; the `vocab` most frequent words are classes of their own."""
    spark = docs.sparkSession
    train = docs.where(is_train).select(F.col(text_col).alias("text"))
    counts = staged(token_counts(train), "tokens")
    n, distinct, ends = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1)), F.coalesce(F.sum(F.when(F.col("token").isNull(), F.col("n"))), F.lit(0))).first()
    words = counts.where("token is not null")
    least = least_count(n)
    many = words.where(F.col("n") >= least).count()
    # the head, or the vocabulary if that is larger, by a least count: no task sorts what others have
    most = words.where(F.col("n") >= head_count(words, max(head, many))).toArrow()
    tops = sorted(zip(most["token"].to_pylist(), most["n"].to_pylist()), key=lambda x: (-x[1], x[0]))
    index = {w: i + 1 for i, (w, _) in enumerate(tops[: max(vocab, many)])}
    top = min(vocab, len(index))
    pairs = staged(followers(train, index, top), "followers")
    classes = np.zeros((top + 2, top + 2))
    got = pairs.where("side = 0").toArrow()  # at most (vocab + 2)^2 rows
    classes[got["i"].to_numpy(), got["k"].to_numpy()] = got["n"].to_numpy()
    r, q, b = fit(classes, dim, noise, steps)
    size = len(index) + 2
    known = np.array([c for _, c in tops[: len(index)]], dtype=np.float64)
    own = np.r_[max(0.0, n - ends - known.sum()), known, ends]
    # words of class 0 start as the class; class 0 itself becomes the words outside the index
    ids = np.r_[np.arange(top + 1), np.zeros(size - top - 2, dtype=np.int64), top + 1]
    wr, wq, wb = r[ids], q[ids], b[ids]
    for x in fit_words(pairs, classes, own, (r, q, b), noise).toLocalIterator():  # a vector for each word
        if x["side"] == 1:
            wr[x["i"]] = x["x"]
        else:
            wq[x["i"]], wb[x["i"]] = x["x"][:-1], x["x"][-1]
    wr, wq, wb = (a.astype(np.float32) for a in (wr, wq, wb))
    return Model(n, distinct, ends, dict(tops), index, (wr, wq, wb, normalisers(spark, wr, wq, wb))), counts


def score(docs: DataFrame, model: Model, counts: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, n_known, base_score, score) of each row.

    base_score: add-one unigram; score: the model's log10 probability of the text.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    df = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = df.schema["id"].dataType.simpleString()
    ddl = f"row long, id {id_type}, n_tokens long, known long, logs double, model double, others long, tail array<binary>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        end, rest = len(m.index) + 1, np.log10(m.rest)
        logs = {w: float(np.log10(c + 1)) for w, c in m.head.items()}
        end_log = float(np.log10(m.ends + 1))
        index, log = m.index.get, logs.get
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n_tokens", "known", "logs", "model", "others", "tail")}
            for t in batch.column("text").to_pylist():
                words = tokens(t)
                ids = np.fromiter((index(w, 0) for w in words), dtype=np.int64, count=len(words))
                own = [log(w) for w in words]
                tail = [w for w, x in zip(words, own) if x is None]
                flat = np.array([0.0 if x is None else x for x in own])
                other = ids == 0
                out["n_tokens"].append(len(words) + 1)
                out["known"].append(len(words) - len(tail) + (m.ends > 0))
                out["logs"].append(float(flat.sum()) + end_log)
                out["model"].append(float(m.log10(np.r_[end, ids], np.r_[ids, end]).sum(dtype=np.float64) + flat[other].sum() - rest * other.sum()))
                out["others"].append(int(other.sum()))
                out["tail"].append(tail)
            types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64(), pa.list_(pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("id"), *(pa.array(v, t) for v, t in zip(out.values(), types))], names=["row", "id", *out])

    done = staged(map_arrow(df, run, ddl), "scored")
    # tokens beyond the head: each is rare, so no key is hot
    tail = done.select("row", F.explode("tail").alias("token")).join(counts.where("token is not null"), "token")
    more = tail.groupBy("row").agg(F.sum(F.log10(F.col("n") + 1)).alias("tail_logs"), F.count(F.lit(1)).alias("tail_known"))
    joined = done.drop("tail").join(more, "row", "left")
    logs = F.coalesce("tail_logs", F.lit(0.0))
    base = float(np.log10(model.n + model.distinct + 1))
    return joined.select(
        F.col("id").alias(id_col),
        "n_tokens",
        (F.col("known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        (F.col("logs") + logs - F.col("n_tokens") * F.lit(base)).alias("base_score"),
        (F.col("model") + logs).alias("score"),
    )
