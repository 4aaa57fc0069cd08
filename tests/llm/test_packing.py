import bisect
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers as P
from hypothesis import given, settings
from hypothesis import strategies as st
from lattica.llm import bpe, packing
from lattica.llm.common import table
from lattica.llm.queries import op3_best_fit_packing
from tests.llm.helpers import AWKWARD, docs
from tokenizers import Tokenizer

ARGS = (P.path("byte_bpe_50k.tiktoken"), P.PATTERN, 2)


def ids_of(text):
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    return [*t.encode(text or "", add_special_tokens=False).ids, 2]


def valid(rows, capacity):
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
    return len(bins)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 200), max_size=30))
def test_rounds_place_every_piece_once(counts):
    matches, bins = packing.best_fit_rounds(counts, 30)
    used, placed = Counter(), Counter()
    for size, rank, n, first, offset, each in sorted(matches, key=lambda m: m[4]):
        for i in range(n):
            assert used[first + i // each] == offset + i % each * size
            used[first + i // each] += size
            placed[size, rank + i] += 1
    assert placed == Counter((s, r) for s, n in counts.items() for r in range(n))
    assert all(v <= 30 for v in used.values()) and len(used) == bins
    total = sum(s * n for s, n in counts.items())
    assert bins <= 11 / 9 * max(-(-total // 30), sum(n for s, n in counts.items() if s > 15)) * 1.25 + 2


def best_fit(lengths, capacity):
    """One piece at a time, longest first, each to the smallest gap that holds it."""
    gaps, bins = [], 0
    for size in sorted(lengths, reverse=True):
        i = bisect.bisect_left(gaps, size)
        gap = gaps.pop(i) if i < len(gaps) else capacity
        bins += i == len(gaps) and gap == capacity
        if gap > size:
            bisect.insort(gaps, gap - size)
    return bins


@settings(max_examples=200, deadline=None)
@given(st.sampled_from([7, 64, 1024]), st.lists(st.floats(0, 1), max_size=300))
def test_as_many_bins_as_sequential_best_fit(capacity, shares):
    lengths = [max(1, round(x**3 * capacity)) for x in shares]
    assert packing.best_fit_rounds(dict(Counter(lengths)), capacity)[1] == best_fit(lengths, capacity)


def test_pieces_and_places(spark):
    rows = packing.pack(docs(spark, length=9, piece="x", offset=1), *ARGS, capacity=64).collect()
    want = Counter()
    for i, t in AWKWARD:
        ids = ids_of(t)
        start = 0
        for k, n in enumerate(packing.cut_lengths(len(ids), 64)):
            want[i, k, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())] += 1
            start += n
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    valid(rows, 64)


def test_real_documents_near_the_lower_bound(spark, sf):
    rows = packing.pack(table(spark, sf, "documents"), *ARGS).collect()
    assert valid(rows, 1024) <= 1.02 * -(-sum(r.length for r in rows) // 1024) + 1


def test_sequences_hold_the_ids(spark):
    df = docs(spark, [(1, "a b c"), (2, "d e"), (3, None)])
    placed = packing.pack(df, *ARGS)
    (row,) = packing.sequences(df, placed, *ARGS).collect()
    got = np.frombuffer(row.ids, "<u4").tolist()
    parts = {r.doc_id: got[r.offset : r.offset + r.length] for r in placed.collect()}
    assert parts == {1: ids_of("a b c"), 2: ids_of("d e"), 3: [2]}


def test_empty_table(spark):
    assert packing.pack(docs(spark, []), *ARGS).collect() == []


def test_added_tokens_inside_texts(spark, tmp_path):
    """Ids are those of the library's defaults, in the query and in the packed sequences."""
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    texts = ["hello <|endoftext|> world", "<|endoftext|>", "a<|endoftext|><|endoftext|>b  ", "<|endoftext|", "x  <|endoftext|>\n\n <|endoftext|>é" * 400, None]
    df = docs(spark, list(enumerate(texts)))
    df.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    want = Counter()
    for i, text in enumerate(texts):
        ids, start = [*t.encode(text or "", add_special_tokens=False).ids, 2], 0
        for k, n in enumerate(packing.cut_lengths(len(ids), 1024)):
            want[i, k, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())] += 1
            start += n
    rows = op3_best_fit_packing(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert max(r.piece for r in rows) > 0
    special = bpe.added_tokens(P.path("byte_bpe_50k.json"))
    short = df.where("doc_id < 4")
    packed = packing.sequences(short, packing.pack(short, *ARGS, special=special), *ARGS, special=special).collect()
    assert sum(np.frombuffer(r.ids, "<u4").tolist().count(50256) for r in packed) == 4
