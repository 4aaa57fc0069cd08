"""Byte-level BPE encoding by overlapping chunks, and decoding.

A text of at most `chunk_chars` characters is one piece. A longer one is cut
into windows that start every `chunk_chars` characters and overlap the next by
`overlap`. Windows are pre-tokenised in parallel. A window's scan starts in the
middle of nowhere, so its first boundaries may be wrong; it joins the true scan
at the first position in the overlap that is a boundary of both its own scan and
its predecessor's (from a common position on, two scans agree). Texts are cut
there, and the pieces are encoded in parallel and put together again in order.
Where some window shares no boundary with its predecessor (an unbroken run
longer than the overlap), that whole document is encoded as one piece.

Null texts are empty and have no ids; repeated rows give repeated results; an
empty table gives an empty table.
"""

from __future__ import annotations

import base64
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lattica.llm.common import map_batches, staged, texts_of

CHUNK_CHARS, OVERLAP = 32_768, 1_024


@lru_cache(maxsize=4)
def encoding(path: str, pattern: str, special: tuple[tuple[str, int], ...] = ()) -> tiktoken.Encoding:
    """The encoding of a rank file with the special tokens given, by default none; built once per Python worker."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(special))


def added_tokens(path: str) -> tuple[tuple[str, int], ...]:
    """(content, id) of the added tokens of a `tokenizers` JSON file, which that library finds inside texts before any merge."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f).get("added_tokens") or []
    if any(t.get(flag) for t in found for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"added tokens of {path} aren't plain strings")
    return tuple((t["content"], t["id"]) for t in found)


def scan_boundaries(window: str, pattern: str, lo: int, hi: int, last: bool) -> list[int]:
    """Ends of pre-tokens in [lo, hi) of a window's scan.

    An end is sure only if a character follows it and one more is in sight (the
    pattern looks one character ahead), unless the text ends with the window.
    """
    sure = len(window) if last else len(window) - 2
    ends = []
    for m in regex.compile(pattern).finditer(window):
        if m.end() >= hi or m.end() > sure:
            break
        if m.end() >= lo:
            ends.append(m.end())
    return ends


def encode(docs: DataFrame, vocab: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", chunk_chars: int = CHUNK_CHARS, overlap: int = OVERLAP) -> DataFrame:
    """(id_col, ids array<int>) for each row; `vocab` is the path of a rank file."""
    if not 2 < overlap <= chunk_chars:
        raise ValueError("overlap must be over 2 and at most chunk_chars")
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    id_type = docs.schema["id"].dataType.simpleString()
    is_long = F.length("text") > chunk_chars

    def encode_texts(batch: pa.RecordBatch) -> dict:
        enc = encoding(vocab, pattern)
        # as arrays: a list of Python integers takes nine times the memory
        ids = [np.array(enc.encode_ordinary(t), dtype=np.int32) for t in texts_of(batch)]
        return {n: batch.column(n) for n in batch.schema.names if n != "text"} | {"ids": pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, ids)]), pa.int32()), pa.array(np.concatenate(ids), pa.int32()))}

    def cut(batch: pa.RecordBatch) -> dict:
        out: dict = {"id": [], "rid": [], "k": [], "window": [], "last": []}
        for i, rid, t in zip(batch.column("id").to_pylist(), batch.column("rid").to_pylist(), texts_of(batch)):
            starts = range(0, len(t), chunk_chars)
            for k, s in enumerate(starts):
                out["id"].append(i)
                out["rid"].append(rid)
                out["k"].append(k)
                out["window"].append(t[s : s + chunk_chars + overlap])
                out["last"].append(s + chunk_chars + overlap >= len(t))
        return out

    def scan(batch: pa.RecordBatch) -> dict:
        left, right = [], []
        for w, last in zip(batch.column("window").to_pylist(), batch.column("last").to_pylist()):
            ends = scan_boundaries(w, pattern, 0, chunk_chars + overlap, last)
            left.append([0] * (not ends or ends[0] > 0) + [e for e in ends if e < overlap])
            right.append([e - chunk_chars for e in ends if e >= chunk_chars])
        return {n: batch.column(n) for n in ("id", "rid", "k", "window")} | {"left": left, "right": right}

    short = map_batches(docs.where(~is_long), encode_texts, f"id {id_type}, ids array<int>")

    windows = map_batches(docs.where(is_long).withColumn("rid", F.monotonically_increasing_id()), cut, f"id {id_type}, rid long, k int, window string, last boolean")
    # written once, as both those that are stitched and those that are lost come from it
    scanned = staged(map_batches(windows.repartition("rid", "k"), scan, f"id {id_type}, rid long, k int, window string, left array<int>, right array<int>"), "windows")
    order, whole = W.partitionBy("rid").orderBy("k"), W.partitionBy("rid")
    stitched = (
        scanned.withColumn("start", F.when(F.col("k") == 0, F.lit(0)).otherwise(F.array_min(F.array_intersect("left", F.lag("right").over(order)))))
        .withColumn("next", F.lead("start").over(order))
        .withColumn("lost", F.max(F.col("start").isNull()).over(whole))
        .withColumn("more", F.lead(F.lit(True)).over(order))
    )
    # a window's own part ends where the next one takes over; without a common boundary the parts are the plain chunks, to be joined again
    begin = F.when(F.col("lost"), F.lit(0)).otherwise(F.col("start"))
    end = F.when(F.col("more").isNull(), F.length("window")).when(F.col("lost"), F.lit(chunk_chars)).otherwise(F.col("next") + chunk_chars)
    pieces = stitched.select("id", "rid", "k", "lost", F.substring("window", begin + 1, end - begin).alias("text"))
    encoded = map_batches(pieces.where(~F.col("lost")).drop("lost").repartition("rid", "k"), encode_texts, f"id {id_type}, rid long, k int, ids array<int>")
    joined = encoded.groupBy("rid").agg(F.first("id").alias("id"), F.sort_array(F.collect_list(F.struct("k", "ids"))).alias("p")).select("id", F.flatten("p.ids").alias("ids"))
    rest = pieces.where(F.col("lost")).groupBy("rid").agg(F.first("id").alias("id"), F.sort_array(F.collect_list(F.struct("k", "text"))).alias("p")).select("id", F.array_join("p.text", "").alias("text"))
    return short.unionByName(joined).unionByName(map_batches(rest, encode_texts, f"id {id_type}, ids array<int>")).withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocab: str, pattern: str, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Adds the bytes of the ids, concatenated; null ids give null. Bytes need not be UTF-8: ids may split a character."""

    names = encoded.columns

    def decoded(batch: pa.RecordBatch) -> dict:
        enc = encoding(vocab, pattern)
        column = batch.column(ids_col)
        out = [None if not x.is_valid else enc.decode_bytes(x.values.to_numpy(zero_copy_only=False).tolist()) for x in column]
        return {n: batch.column(n) for n in names if n != out_col} | {out_col: out}

    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields if f.name != out_col)
    return map_batches(encoded, decoded, f"{ddl}, `{out_col}` binary")
