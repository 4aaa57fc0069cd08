import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lattica.llm import topk
from lattica.llm.common import table
from lattica.llm.queries import op2_exact_top_k
from pyspark.sql import functions as F


def brute(rows, is_query, k, scale=64):
    good = [(i, [math.floor(float(x) * scale) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qid, q in good:
        if is_query(qid):
            found = sorted((-sum(a * b for a, b in zip(q, v)), i) for i, v in good if i != qid)[:k]
            out += [(qid, r + 1, i, max(-(2**63), min(2**63 - 1, -s))) for r, (s, i) in enumerate(found)]
    return sorted(out)


def result(df, is_query, k, **options):
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.top_k(df, is_query, k=k, **options).collect())


def test_all_of_a_table(spark, sf):
    rows = [(r.vec_id, r.embedding) for r in table(spark, sf, "embeddings").collect()]
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in op2_exact_top_k(spark, sf).collect())
    assert got == brute(rows, lambda i: i % 20 == 0, 20)


@pytest.mark.parametrize("block_rows,block_queries", [(7, 2), (1000, 1000)])
def test_awkward_vectors(spark, block_rows, block_queries):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [0.5, -0.25]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (None, [1.0, 1.0]), (6, [0.5, -0.25]), (7, [1.0]), (8, []), (9, [1e9, -3e8]), (10, [0.0, 0.0])] + [(20 + i, [(-1) ** i * i / 9, i / 7]) for i in range(25)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"score": F.lit(1), "id": F.lit("x"), "b": F.lit(2)})
    assert result(df, F.col("vec_id") % 2 == 0, 4, block_rows=block_rows, block_queries=block_queries) == brute(rows, lambda i: i % 2 == 0, 4)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 1.0]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert result(df, F.col("vec_id") == 10, 5, block_rows=8) == brute(rows, lambda i: i == 10, 5)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-40, 40), min_size=3, max_size=3), min_size=1, max_size=90), st.lists(st.integers(-40, 40), min_size=3, max_size=3), st.integers(1, 12))
def test_slices_add_up(values, query, k):
    block = topk.SlicedBlock(np.arange(len(values)), np.array(values))
    ids, scores = block.top(query, -1, k)
    want = sorted((-sum(a * b for a, b in zip(query, v)), i) for i, v in enumerate(values))[:k]
    assert sorted(zip([-s for s in scores], ids.tolist())) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 2 == 0).collect() == []


def test_repeated_query_rows_are_ranked_each(spark):
    rows = [(10, [1.0, 1.0]), (10, [1.0, 1.0]), (10, [-1.0, 0.5])] + [(100 + i, [i / 9, i / 7 - 1]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert result(df, F.col("vec_id") == 10, 6, block_rows=8) == brute(rows, lambda i: i == 10, 6)
