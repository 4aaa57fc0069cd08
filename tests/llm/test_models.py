"""Toxicity, quality classifier and language model."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from lattica.llm import lm_scoring, quality_classifier, toxicity
from lattica.llm.common import fold, table
from lattica.llm.queries import op5_toxicity, op7_quality_classifier, op10_lm_scoring
from lattica.llm.sampling import labelled
from pyspark.sql import functions as F
from tests.llm.helpers import AWKWARD, docs

SF = "/root/testdata/sf0.1"


def crc(i, n):
    return zlib.crc32(b"" if i is None else str(i).encode()) % n


def auc(scores, labels):
    order = np.argsort(scores, kind="stable")
    ranks = np.empty(len(order))
    ranks[order] = np.arange(1, len(order) + 1)
    y = np.array(labels) > 0
    return (ranks[y].sum() - y.sum() * (y.sum() + 1) / 2) / y.sum() / (~y).sum()


def with_labels(spark, rows, label):
    labels = {r.doc_id: r[label] for r in table(spark, SF, "labels").collect()}
    return [(r, labels[r.doc_id]) for r in rows if labels.get(r.doc_id) is not None]


def test_toxicity_on_held_out_documents(spark):
    rows = op5_toxicity(spark, SF).collect()
    assert len(rows) == table(spark, SF, "documents").count()
    assert all(r.held_out == (crc(r.doc_id, 5) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r, y) for r, y in with_labels(spark, rows, "toxic") if r.held_out]
    assert auc([r.score for r, _ in held], [y for _, y in held]) > 0.95
    assert sum(r.predicted for r, y in held if not y) < 0.02 * len(held)


def test_kneser_ney_by_definition():
    """Both models as sums over all pairs of a small corpus; each is a distribution over the words and the unseen."""
    texts = [("a b c a", 0), ("a b d", 0), ("a b c e", 0), ("x b a", 1), ("x c a b", 1), ("a x b", 1), ("a b z", 0)]
    pairs = [Counter(), Counter()]
    for t, y in texts:
        words = t.split()
        pairs[y].update(set(zip(["", *words], words)))
    every, min_pair = set(pairs[0]) | set(pairs[1]), 2
    words = sorted({v for _, v in every})
    kept = {k: (pairs[0][k], pairs[1][k]) for k in every if pairs[0][k] + pairs[1][k] >= min_pair}
    before = {v: [sum(1 for p in every if p[1] == v and pairs[k][p]) for k in (0, 1)] + [sum(1 for p in every if p[1] == v)] for v in words}
    total = [sum(c for c in pairs[k].values()) for k in (0, 1)]
    assert all(total)

    def rate(counts):
        n1, n2 = sum(c == 1 for c in counts), sum(c == 2 for c in counts)
        return n1 / (n1 + 2 * n2)

    d = [rate(pairs[k].values()) for k in (0, 1)]
    heads = {w: tuple(sum(c for p, c in pairs[k].items() if p[0] == w) for k in (0, 1)) for w, _ in every}
    model = toxicity.ToxicityModel({v: tuple(n) for v, n in before.items()}, heads, kept, tuple(d), (4, 3))

    def shared(v):
        return (before.get(v, (0, 0, 0))[2] + 0.5) / (len(every) + 0.5 * (len(words) + 1))

    def word(v, k):
        e, n = rate([b[k] for b in before.values()]), sum(b[k] for b in before.values())
        own = before.get(v, (0, 0, 0))[k]
        return max(own - e, 0) / n + sum(min(e, b[k]) for b in before.values()) / n * shared(v)

    def pair(w, v, k):
        if w not in {h for h, _ in kept} or not heads[w][k]:
            return word(v, k)
        seen = {x: max(c[k] - d[k], 0) / heads[w][k] for (h, x), c in kept.items() if h == w}
        return seen.get(v, 0) + (1 - sum(seen.values())) * word(v, k)

    for k in (0, 1):
        assert math.isclose(sum(word(v, k) for v in [*words, "unseen"]), 1)
        assert all(math.isclose(sum(pair(w, v, k) for v in [*words, "unseen"]), 1) for w in heads)
    for t in ("a b c", "x b unseen a x", "b a", "unseen"):
        own = t.split()
        assert np.allclose(model.differences(own), [math.log(pair(w, v, 1) / pair(w, v, 0)) for w, v in zip(["", *own], own)])


def test_toxicity_ignores_labels_of_the_held_out(spark, sf):
    d, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    other = labels.withColumn("toxic", F.when(fold(F.col("doc_id"), 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    key = lambda df: sorted((r.doc_id, r.score) for r in df.collect())
    assert key(toxicity.toxicity(d, labels)) == key(toxicity.toxicity(d, other))


@pytest.mark.parametrize("rows", [[], [(1, 0)], [(1, 1), (5, 1), (None, 0), (6, None)], [(i, i % 2) for i in (1, 2, 3, 5, 6, 7, 8)]])
def test_models_of_awkward_documents_and_labels(spark, rows):
    labels = spark.createDataFrame([(i, y, y) for i, y in rows], "doc_id long, quality int, toxic int")
    df = docs(spark, score=1, _label="x", _s=2, row="r")
    tox = toxicity.toxicity(df, labels).collect()
    assert Counter(r.doc_id for r in tox) == Counter(i for i, _ in AWKWARD) and all(0 <= r.score <= 1 for r in tox)
    graded = quality_classifier.graded(df, labels).collect()
    assert Counter(r.doc_id for r in graded) == Counter(i for i, _ in AWKWARD) and all(0 <= r.tail <= 1 for r in graded)
    assert quality_classifier.filtered(df, labels).columns == df.columns
    assert toxicity.toxicity(docs(spark, []), labels).collect() == [] == quality_classifier.graded(docs(spark, []), labels).collect()


def test_quality_on_held_out_documents(spark):
    rows = op7_quality_classifier(spark, SF).collect()
    held = [(r, y) for r, y in with_labels(spark, rows, "quality") if r.held_out]
    assert auc([r.expected_grade for r, _ in held], [y for _, y in held]) > 0.97
    assert sum(r.kept for r, y in held if y) > 0.97 * sum(y for _, y in held)
    assert sum(r.kept for r, y in held if not y) < 0.1 * sum(not y for _, y in held)


def test_grades_of_labels_set_two_thresholds(spark):
    """Three grades: toxic documents of good quality are between the others, and stay."""
    d, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality_classifier.train(d, labels, F.lit(True))
    assert model.grades == [0.0, 1.0, 2.0] and model.thresholds[0] < model.thresholds[1]
    both = {r.doc_id: (r.quality, r.toxic) for r in labels.collect()}
    rows = [r for r in quality_classifier.graded(d, labels).collect() if r.held_out and r.doc_id in both]
    mean = lambda q, t: np.mean([r.expected_grade for r in rows if both[r.doc_id] == (q, t)])
    assert mean(0, 0) < mean(1, 1) < mean(1, 0)
    assert np.mean([r.kept for r in rows if both[r.doc_id] == (1, 1)]) > 0.9


def test_likelihood_of_a_small_ordinal_model():
    """The fit's slope vanishes where it stops: the brute-force likelihood has no better point around it."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 3))
    level = np.searchsorted([-0.5, 1], x @ [1.0, -1, 0.5] + rng.logistic(size=200))
    m = quality_classifier.fit(np.repeat(np.arange(200), 3), np.tile(np.arange(3), 200), x.ravel(), [0.0, 1.0, 2.0], level, 3, steps=3000, ridge=0.0)

    def likelihood(w, cuts):
        edge = [-math.inf, *cuts, math.inf]
        f = lambda v: 1 / (1 + math.exp(-v)) if abs(v) < 700 else float(v > 0)
        return sum(math.log(f(edge[k + 1] - z) - f(edge[k] - z)) for z, k in zip((x @ w).tolist(), level.tolist()))

    best = likelihood(m.weights, m.thresholds)
    for i in range(5):
        for step in (-0.05, 0.05):
            p = np.r_[m.weights, m.thresholds]
            p[i] += step
            assert likelihood(p[:3], p[3:]) < best + 1e-3


def test_labelled_rows_are_bounded_by_id(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(50)], "doc_id long, quality int, toxic int")
    rows = docs(spark, [(3, f"text {i}") for i in range(200)] + [(i, "other") for i in range(50)])
    assert labelled(rows, labels, F.col("quality"), F.lit(True), 20).count() == 20
    whole = labelled(rows, labels, F.col("quality"), F.lit(True), 60).collect()
    assert sorted(r.doc_id for r in whole) == list(range(50))


def test_ordinal_model_keeps_thresholds_ordered_and_recovers_grades():
    rng = np.random.default_rng(0)
    n, dims = 3000, 50
    x, w = rng.normal(size=(n, dims)), rng.normal(size=dims)
    z = x @ w + rng.logistic(size=n)
    level = np.searchsorted([-6, 0, 1, 7], z)
    where, index = np.repeat(np.arange(n), dims), np.tile(np.arange(dims), n)
    m = quality_classifier.fit(where, index, x.ravel(), [1.0, 2.0, 3.0, 4.0, 5.0], level, dims, steps=600)
    assert (np.diff(m.thresholds) > 0).all()
    q = x @ m.weights
    assert np.corrcoef(m.expected(q), level)[0, 1] > 0.9
    assert abs(m.tails(q).mean(axis=0) - np.array([(level >= k).mean() for k in range(1, 5)])).max() < 0.03


def slow_base(rows):
    words = {id(r): [*re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r[1] or "")), None] for r in rows}
    count = Counter(w for r in rows if crc(r[0], 7) != 2 for w in words[id(r)])
    n, v = sum(count.values()), len(count)
    return sorted(((r[0] or 0, crc(r[0], 7) == 2, len(words[id(r)]), sum(count[w] > 0 for w in words[id(r)]), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words[id(r)]), 6)) for r in rows), key=str)


def scored(df, **options):
    held = fold(F.col("doc_id"), 7) == 2
    model, counts = lm_scoring.train_model(df, ~held, **options)
    rows = lm_scoring.score(df, model, counts).withColumn("h", held).collect()
    return model, rows, sorted(((r.doc_id or 0, r.h, r.n_tokens, r.n_known, model.n, round(r.base_score, 6)) for r in rows), key=str)


@pytest.mark.parametrize("options", [{"vocab": 3, "head": 5}, {"vocab": 50, "head": 10_000}])
def test_base_scores(spark, options):
    rows = [*AWKWARD, *((100 + i, f"Tail{i % 13} the The THE word{i} fox") for i in range(40))]
    model, out, got = scored(docs(spark, rows, token="t", n=1, row=2, tail="x"), steps=20, **options)
    assert got == slow_base([tuple(r) for r in rows])
    assert all(r.score < 0 and math.isfinite(r.score) for r in out)


def test_model_is_a_distribution(spark):
    """The probabilities of all one-word continuations, and of the unseen, sum to one."""
    rows = [(i, "a b a c " + f"w{i}") for i in range(20)]
    model, *_ = scored(docs(spark, rows), vocab=2, head=100, steps=30)
    p = 10.0 ** model.matrix.astype(float)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
    others = sum(c + 1 for w, c in model.head.items() if w not in model.index) + 1
    assert others == model.rest


def test_model_beats_the_base_on_held_out_documents(spark):
    rows = [r for r in op10_lm_scoring(spark, SF).collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows) + 0.05 * sum(r.n_tokens for r in rows)


def test_empty_table(spark):
    model, rows, _ = scored(docs(spark, []), steps=5)
    assert rows == [] and model.n == 0


def test_the_vocabulary_and_its_followers_grow_with_the_corpus(spark):
    """Words beyond the `vocab` most frequent have follower statistics of their own, as contexts and as tokens."""
    rows = [(i, f"the a{i % 30} b{i % 30} the") for i in range(1200)]
    model, *_ = scored(docs(spark, rows), vocab=1, head=100)
    assert {w for w in model.index} == {b"the"} | {f"{x}{i}".encode() for x in "ab" for i in range(30)}
    p, at = 10.0 ** model.matrix.astype(float), model.index
    assert np.allclose(p.sum(axis=1), 1, atol=1e-4)
    a, b = [at[f"a{i}".encode()] for i in range(30)], [at[f"b{i}".encode()] for i in range(30)]
    assert (p[a, at[b"the"]] < 0.5 * p[b, at[b"the"]]).all()
    assert p[at[b"the"]][a].sum() > 2 * p[at[b"the"]][b].sum()


def test_quality_features_cover_long_runs():
    """What follows the first 64 bytes of a run counts, in words and in shapes; short words are as ever."""
    pairs = lambda t: dict(zip(*(x.tolist() for x in quality_classifier.features(t))))
    head = "ab1" * 30
    assert pairs(head + "c") != pairs(head + "d")
    assert pairs("a1" * 40) != pairs("a1" * 40 + "-A" * 20)
    assert zlib.crc32(b"word", ord("w")) % quality_classifier.DIMS in pairs("a word")
