"""Best-fit packing of token sequences into bins of a fixed capacity.

Documents are tokenised and cut (only those longer than the capacity; the first
piece takes the remainder, the others are full). The pieces are range-sorted by
length, which gives each a rank within its length. Lengths are integers up to
the capacity, so the sorted pieces, and likewise the open gaps, are runs of equal
values: at most `capacity` of them however large the corpus. Bulk-synchronous
rounds then go down the runs. In a round each pending run looks for its
successor, the smallest gap that holds it; members that want the same gaps are
matched by rank; the matched bins become smaller gaps; what finds no gap opens
bins. The result is that of best fit with the longest piece first. The rounds yield intervals (length, ranks) -> (sequences, offset), by which
every piece finds its place in one distributed pass. Only the run lengths and
those intervals, both bounded by the capacity and not by the corpus, are on the
driver.

Added tokens of the vocabulary are found inside texts, as the `tokenizers` library
does by default. Null texts count as empty: a single end token. Repeated rows are packed each; an
empty table gives an empty table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.bpe import encoding
from lattica.llm.common import map_batches, staged, texts_of

CAPACITY = 1024
_RANK_BITS = 44


def cut_lengths(n: int, capacity: int) -> list[int]:
    """Lengths of the pieces of a document of n tokens."""
    if n <= capacity:
        return [n]
    return [n % capacity] * (n % capacity > 0) + [capacity] * (n // capacity)


def token_pieces(docs: DataFrame, vocab: str, pattern: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, special: tuple[tuple[str, int], ...] = ()) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32[, ids binary]) of every document; ids are little-endian uint32.

    special: (content, id) of the added tokens, found wherever a text holds them.
    """
    docs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = docs.schema["id"].dataType.simpleString()

    def pieces(batch: pa.RecordBatch) -> dict:
        enc = encoding(vocab, pattern, special)
        out: dict = {"id": [], "piece": [], "start": [], "length": [], "ids_crc32": []} | ({"ids": []} if with_ids else {})
        for i, t in zip(batch.column("id").to_pylist(), texts_of(batch)):
            ids = np.array([*enc.encode(t, allowed_special="all", disallowed_special=()), end_id], dtype="<u4").tobytes()
            start = 0
            for k, n in enumerate(cut_lengths(len(ids) // 4, capacity)):
                part = ids[4 * start : 4 * (start + n)]
                for name, v in (("id", i), ("piece", k), ("start", start), ("length", n), ("ids_crc32", zlib.crc32(part)), ("ids", part)):
                    if name in out:
                        out[name].append(v)
                start += n
        return out

    return map_batches(docs, pieces, f"id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids).withColumnRenamed("id", id_col)


def best_fit_rounds(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """Matches of runs of pieces to runs of gaps, and the number of bins: that of best fit, one piece at a time, longest first.

    counts: pieces of each length. A match (length, rank, n, bin, offset, each) puts
    the n pieces from `rank` on into the bins from `bin` on, `each` after another in
    every bin, the last of which may get fewer. What is left of a piece's gap is the
    smallest that holds the next of its length, as long as it holds one.
    """
    gaps: dict[int, list[tuple[int, int]]] = {}  # free tokens -> runs (first bin, number)
    free = 0  # bit g: there are bins with g free tokens
    matches, bins = [], 0

    def keep(gap: int, first: int, n: int) -> None:
        nonlocal free
        if gap and n:
            gaps.setdefault(gap, []).append((first, n))
            free |= 1 << gap

    for size in sorted((s for s, n in counts.items() if n > 0), reverse=True):
        rank, pending = 0, counts[size]
        while pending:
            above = free >> size
            if above:
                gap = size + (above & -above).bit_length() - 1
            else:
                gap, opened = capacity, -(-pending // (capacity // size))
                keep(gap, bins, opened)
                bins += opened
            each, runs = gap // size, gaps[gap]
            while runs and pending:
                first, n = runs.pop()
                take = min(n * each, pending)
                whole, part = divmod(take, each)
                matches.append((size, rank, take, first, capacity - gap, each))
                keep(gap - each * size, first, whole)
                if part:
                    keep(gap - part * size, first + whole, 1)
                used = whole + (part > 0)
                if used < n:
                    runs.append((first + used, n - used))
                rank += take
                pending -= take
            if not runs:
                free &= ~(1 << gap)
    return matches, bins


def place(pieces: DataFrame, capacity: int = CAPACITY, order: Iterable[str] = ()) -> DataFrame:
    """Adds sequence_id and offset to pieces that have a `length` of 1 to `capacity`; `order` settles ranks within a length."""
    spark = pieces.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ["length", *order]
    ranged = staged(pieces.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id()), "ranged")
    # one row for each length and partition: at most capacity + n, as the partitions are ranges of length
    runs = ranged.groupBy("length", F.shiftright("_at", 33).alias("part")).agg(F.min("_at").alias("at"), F.count(F.lit(1)).alias("n")).collect()
    runs.sort(key=lambda r: (r["length"], r["at"]))
    counts: dict[int, int] = {}
    first_at, first_rank = [], []
    for r in runs:
        first_at.append((r["at"], r["length"]))
        first_rank.append(counts.get(r["length"], 0))
        counts[r["length"]] = first_rank[-1] + r["n"]
    matches, _ = best_fit_rounds(counts, capacity)
    by_at = sorted(zip(first_at, first_rank))
    at, rank0 = np.array([a for (a, _), _ in by_at], dtype=np.int64), np.array([r for _, r in by_at], dtype=np.int64)
    m = np.array(sorted(matches), dtype=np.int64).reshape(-1, 6)
    key = (m[:, 0] << _RANK_BITS) | m[:, 1]
    kept = [f for f in pieces.schema.fields]

    def find(batch: pa.RecordBatch) -> dict:
        pos, length = batch.column("_at").to_numpy(), batch.column("length").to_numpy().astype(np.int64)
        run = np.searchsorted(at, pos, side="right") - 1
        rank = rank0[run] + pos - at[run]
        hit = np.searchsorted(key, (length << _RANK_BITS) | rank, side="right") - 1
        nth, each = rank - m[hit, 1], m[hit, 5]
        return {f.name: batch.column(f.name) for f in kept} | {"sequence_id": m[hit, 3] + nth // each, "offset": m[hit, 4] + nth % each * length}

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return map_batches(ranged, find, f"{ddl}, sequence_id long, offset long")


def pack(docs: DataFrame, vocab: str, pattern: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", special: tuple[tuple[str, int], ...] = ()) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, sequence_id, offset) of every piece of every document."""
    return place(staged(token_pieces(docs, vocab, pattern, end_id, capacity, id_col, text_col, special=special), "pieces"), capacity, (id_col, "piece"))


def sequences(docs: DataFrame, placed: DataFrame, vocab: str, pattern: str, end_id: int, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", special: tuple[tuple[str, int], ...] = ()) -> DataFrame:
    """(sequence_id, n_tokens, ids binary): the packed sequences themselves; id_col must be a key here."""
    own = token_pieces(docs, vocab, pattern, end_id, capacity, id_col, text_col, with_ids=True, special=special)
    return (
        own.join(placed.select(id_col, "piece", "sequence_id", "offset"), [id_col, "piece"])
        .groupBy("sequence_id")
        .agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
        .select("sequence_id", "n_tokens", F.expr("aggregate(p.ids, cast('' as binary), (a, x) -> concat(a, x))").alias("ids"))
    )
