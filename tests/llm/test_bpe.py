import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from lattica.llm import bpe
from lattica.llm.common import table
from tests.llm.helpers import AWKWARD, docs

VOCAB = P.path("byte_bpe_multi_50k.tiktoken")


def expected(text):
    return bpe.encoding(VOCAB, P.PATTERN).encode_ordinary(text or "")


@pytest.mark.parametrize("chunk,overlap", [(40, 12), (64, 64), (32768, 1024)])
def test_awkward_texts_at_any_chunk_size(spark, chunk, overlap):
    df = docs(spark, ids="clash", k=1, window="w", rid=2)
    out = bpe.decode(bpe.encode(df, VOCAB, P.PATTERN, chunk_chars=chunk, overlap=overlap), VOCAB, P.PATTERN).collect()
    got = sorted((r.doc_id or 0, list(r.ids), bytes(r.decoded)) for r in out)
    assert got == sorted((i or 0, expected(t), (t or "").encode()) for i, t in AWKWARD)


def test_chunks_of_real_documents(spark, sf):
    df = table(spark, sf, "documents")
    want = {r.doc_id: expected(r.text) for r in df.collect()}
    got = {r.doc_id: list(r.ids) for r in bpe.encode(df, VOCAB, P.PATTERN, chunk_chars=200, overlap=40).collect()}
    assert got == want


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab1 '\n\t.é s", max_size=60))
def test_agreeing_boundaries_are_true(text):
    """What stitching relies on: from a boundary of the true scan on, a scan that has it agrees."""
    true = [0, *bpe.scan_boundaries(text, P.PATTERN, 0, len(text) + 1, True)]
    for s in range(0, len(text), 7):
        own = [e + s for e in bpe.scan_boundaries(text[s : s + 20], P.PATTERN, 0, 20, s + 20 >= len(text))]
        common = [e for e in own if e in true]
        if common:
            assert [e for e in own if e >= common[0]] == [e for e in true if common[0] <= e <= own[-1]]


def test_empty_table(spark):
    assert bpe.encode(docs(spark, []), VOCAB, P.PATTERN).collect() == []
