"""Exact top-k inner products by a bit-sliced index.

Vectors become integers, floor(scale * x). Rows are dealt into blocks; a block's
index holds, for each dimension and bit, a bitmap over its rows (values are
shifted to be non-negative). A query's scores against a whole block are added
slice by slice: a bitmap of weight 2^(i+j) for each set bit i of the query's
component and bit j of the row's, all bitmaps of one weight by carry-save adders
until one is left, which is that slice of the sum. A negative component adds the
complemented bitmaps; what shifting and complementing add is the same for all
rows. The top rows are then selected from the most significant slice downward: a
slice splits the rows still tied with the boundary into those surely in and those
behind. Rows that end tied are taken by id. Scores are exact integers.

Queries are dealt into blocks too. Every block is written once, as a file in the
shared folder, and only file names move: a task takes one block of queries and a
group of index blocks, opens those one after another, and keeps the best k rows of
each query; of what the groups give the best k are kept again.

Rows with a null id, a null vector, or a vector with null or non-finite
components take no part. A query never finds rows of its own id. Vectors of
unequal length are compared over zeros where one ends. Ties go to the smaller id;
repeated rows are found each. Scores beyond 64 bits are set to the nearest that
fits. An empty table gives an empty table.
"""

from __future__ import annotations

import pickle
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from lattica.llm.common import new_path, open_file, staged

K, SCALE, BLOCK_ROWS, BLOCK_QUERIES, GROUP = 20, 64, 32_768, 512, 16


def quantised(vectors: list[np.ndarray], scale: int) -> np.ndarray:
    """floor(scale * x) as a matrix, zeros after the end of a shorter vector; Python integers where 64 bits might not do."""
    dims = max((len(v) for v in vectors), default=0)
    x = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        x[i, : len(v)] = v
    x = np.floor(x * scale)
    if x.size and np.abs(x).max() >= 2**24:
        return np.array([[int(c) for c in row] for row in x], dtype=object).reshape(x.shape)
    return x.astype(np.int64)


class SlicedBlock:
    """The bit-sliced index of a block of rows, in order of their ids."""

    def __init__(self, ids: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.values = ids[order], values[order]
        if values.dtype != object:
            self.values = self.values.astype(np.min_scalar_type(-1 - int(np.abs(values).max(initial=0))))
        n, dims = values.shape
        self.low = values.min() if values.size else 0
        shifted = values[order] - self.low
        self.bits = int(shifted.max()).bit_length() if shifted.size else 0
        words = -(-n // 64)
        self.live = self._bitmap(np.ones(n, dtype=bool), words)
        self.slices = np.zeros((dims, self.bits, words), dtype=np.uint64)
        for j in range(self.bits):
            bit = ((shifted >> j) & 1).astype(bool)
            for d in range(dims):
                self.slices[d, j] = self._bitmap(bit[:, d], words)

    @staticmethod
    def _bitmap(bits: np.ndarray, words: int) -> np.ndarray:
        out = np.zeros(words * 8, dtype=np.uint8)
        packed = np.packbits(bits, bitorder="little")
        out[: len(packed)] = packed
        return out.view(np.uint64)

    def sums(self, query: list[int]) -> list[np.ndarray]:
        """Slices, least significant first, of a sum that orders the rows as the scores do."""
        by_weight: dict[int, list[tuple[int, int, bool]]] = {}
        for d, c in enumerate(query[: len(self.slices)]):
            for i in range(abs(c).bit_length()):
                if abs(c) >> i & 1:
                    for j in range(self.bits):
                        by_weight.setdefault(i + j, []).append((d, j, c < 0))
        out, carried, w = [], np.zeros((0, len(self.live)), dtype=np.uint64), 0
        while w <= max(by_weight, default=-1) or len(carried):
            picks = by_weight.get(w, [])
            own = self.slices[[d for d, _, _ in picks], [j for _, j, _ in picks]] if picks else carried[:0]
            if picks:
                own[[neg for _, _, neg in picks]] ^= self.live
            rows, carries = np.concatenate([own, carried]), []
            while len(rows) > 1:
                third = len(rows) // 3
                if third:
                    a, b, c = rows[:third], rows[third : 2 * third], rows[2 * third : 3 * third]
                    ab = a ^ b
                    carries.append((a & b) | (ab & c))
                    rows = np.concatenate([ab ^ c, rows[3 * third :]])
                else:
                    carries.append((rows[0] & rows[1])[None])
                    rows = (rows[0] ^ rows[1])[None]
            out.append(rows[0] if len(rows) else np.zeros_like(self.live))
            carried = np.concatenate(carries) if carries else carried[:0]
            w += 1
        return out

    def top(self, query: list[int], query_id: int, k: int) -> tuple[np.ndarray, list[int]]:
        """Ids and scores of the k best rows, unordered; all rows if there are fewer."""
        own = slice(np.searchsorted(self.ids, query_id, "left"), np.searchsorted(self.ids, query_id, "right"))
        tied = self.live
        if own.start < own.stop:
            barred = np.zeros(len(self.ids), dtype=bool)
            barred[own] = True
            tied = self.live & ~self._bitmap(barred, len(self.live))
        chosen, need = np.zeros_like(self.live), k
        for s in reversed(self.sums(query)):
            upper = tied & s
            n = int(np.bitwise_count(upper).sum())
            if n > need:
                tied = upper
            else:
                chosen, need, tied = chosen | upper, need - n, tied & ~s
            if not need:
                break
        at = self._positions(chosen)
        if need:  # all equal on the boundary: the smallest ids
            at = np.r_[at, self._positions(tied)[:need]]
        dims = min(len(query), self.values.shape[1])
        if self.values.dtype == object or max(map(abs, query), default=0) >= 2**24:
            scores = [sum(int(a) * b for a, b in zip(self.values[i, :dims], query)) for i in at]
        else:
            scores = (self.values[at, :dims].astype(np.int64) @ np.array(query[:dims], dtype=np.int64)).tolist()
        return self.ids[at], scores

    def _positions(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), count=len(self.ids), bitorder="little"))


def top_k(rows: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = SCALE, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, id_col, score) of the k best rows for each query row."""
    base = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | x.isin(float("inf"), float("-inf")))
    base = base.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad)
    folder = new_path(rows.sparkSession, "topk")
    n, n_queries = base.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("q").cast("long")), F.lit(0))).first()
    row_blocks, query_blocks = max(1, -(-n // block_rows)), max(1, -(-n_queries // block_queries))

    def kept(name: str, content: object) -> str:
        path = f"{folder}/{name}-{uuid.uuid4().hex}"
        with open_file(path, "w") as f:
            f.write(pickle.dumps(content, protocol=5))
        return path

    def opened(path: str):  # noqa: ANN202
        with open_file(path, "r") as f:
            return pickle.loads(f.read())  # noqa: S301 - our own bytes

    def built(group: pd.DataFrame) -> pd.DataFrame:
        block = SlicedBlock(group["id"].to_numpy(), quantised(list(group["v"]), scale))
        return pd.DataFrame({"b": [int(group["b"].iloc[0])], "path": [kept("block", block)]})

    def gathered(group: pd.DataFrame) -> pd.DataFrame:
        # in a fixed order, so that its place numbers a query row, also one that repeats an id
        own = sorted(zip(group["id"].tolist(), quantised(list(group["v"]), scale).tolist()))
        return pd.DataFrame({"qb": [int(group["qb"].iloc[0])], "queries": [kept("queries", own)]})

    def met(pair: pd.DataFrame) -> pd.DataFrame:
        queries = opened(pair["queries"].iloc[0])
        best: list[list[tuple[int, int]]] = [[] for _ in queries]  # of each query (-score, id)
        for path in pair["paths"].iloc[0]:
            block = opened(path)
            for nth, (qid, q) in enumerate(queries):
                ids, scores = block.top(q, qid, k)
                best[nth] = sorted([*best[nth], *zip((-s for s in scores), ids.tolist())])[:k]
        flat = [(nth, queries[nth][0], i, max(-(2**63), min(2**63 - 1, -s))) for nth, found in enumerate(best) for s, i in found]
        out = pd.DataFrame(flat, columns=["nth", "query_id", "id", "score"], dtype="int64")
        out.insert(0, "qb", int(pair["qb"].iloc[0]))
        return out

    row = F.monotonically_increasing_id()  # rows that repeat an id are dealt out as well
    index = staged(base.withColumn("b", F.pmod(F.xxhash64("id", row), F.lit(row_blocks))).groupBy("b").applyInPandas(built, "b long, path string"), "topk-blocks")
    queries = staged(base.where("q").withColumn("qb", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(query_blocks))).groupBy("qb").applyInPandas(gathered, "qb long, queries string"), "topk-queries")
    # a stated set of queries against all rows, in blocks: a row of file names for each block of queries and group of index blocks
    groups = index.groupBy(F.floor(F.col("b") / GROUP).alias("g")).agg(F.collect_list("path").alias("paths"))  # at most GROUP names
    dealt = groups.withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(query_blocks - 1).cast("long"))))
    pairs = dealt.join(queries, "qb").repartition(min(2_000, max(1, -(-row_blocks // GROUP) * query_blocks)), "qb", "g")
    best = pairs.groupBy("qb", "g").applyInPandas(met, "qb long, nth long, query_id long, id long, score long")
    rank = F.row_number().over(W.partitionBy("qb", "nth").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(id_col), "score")
