import math
import re
import zlib
from collections import Counter

import corpus_pipeline
import duckdb
import numpy as np
from lattica.llm import packing, quality_classifier, quality_rules
from lattica.llm.common import fold, table
from pyspark.sql import functions as F
from tests.llm.helpers import AWKWARD, docs
from tests.llm.test_packing import best_fit, ids_of, valid
from tests.llm.test_quality_rules import WORD
from tests.llm.test_quality_rules import base as measures
from tests.llm.test_secrets import base
from tests.llm.test_simhash import similar_groups

SF = "/root/testdata/sf0.01"


def test_stages_in_turn(spark):
    """Each stage on what its predecessor kept; the pieces are those of the last stage's texts."""
    labels = dict(duckdb.sql(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall())
    kept = table(spark, SF, "documents")
    columns = kept.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, stage(spark, kept, SF).cache()
        assert kept.columns == columns, name
        ids = {r.doc_id for r in kept.select("doc_id").collect()}
        assert ids <= {r.doc_id for r in before.select("doc_id").collect()}
        if name.startswith("quality"):
            good = [i for i in {r.doc_id for r in before.select("doc_id").collect()} if labels.get(i) == 1]
            assert sum(i in ids for i in good) >= 0.88 * len(good), name
        if name.startswith("secret"):
            assert ids == {r.doc_id for r in before.select("doc_id").collect()}
    rows = kept.collect()
    assert not any(base(r.text) for r in rows)
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, SF).collect()
    assert Counter((r.doc_id, sum(p.length for p in pieces if p.doc_id == r.doc_id)) for r in rows[:20]) == Counter((r.doc_id, len(ids_of(r.text))) for r in rows[:20])
    whole = {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()}
    assert whole == {p.doc_id for p in pieces}


def line_goes(line):
    """The line rules, one after another."""
    words = WORD.findall(line)
    n, letters = max(1, len(words)), sum(map(len, words))
    menu, symbols, shouts = (len(re.findall(p, line)) for p in (r"[|»›•·]", r"[#*$%&|<>]", "!!"))
    pointed = re.search("[.,;:!?…。，、！？؟।\"'”’)]", line)
    return (menu >= 2 and menu * 5 >= n) or (symbols >= 6 and symbols * 10 > letters) or (shouts >= 3 and shouts * 3 >= n) or any(p in line.lower() for p in quality_rules.PHRASES) or (bool(words) and not pointed and n >= 25)


def cleaned(text):
    """What the line rules leave of a text; None if the document goes."""
    *_, failed = measures(text)
    left = "\n".join(x for x in (text or "").split("\n") if not line_goes(x))
    remains, whole = (sum(map(len, WORD.findall(t or ""))) for t in (left, text))
    return None if failed or not remains or 2 * remains < whole else left


def masked(text):
    out, at = [], 0
    for start, _, stop in base(text):
        if start >= at:
            out += [text[at:start], "[SECRET]"]
        at = max(at, stop)
    return "".join(out) + text[at:]


def test_pipeline_equals_brute_force(spark, sf):
    """Every stage done anew in plain Python, but for the classifier's fit; a group's first document stays."""
    docs_of, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality_classifier.train(docs_of, labels, fold(F.col("doc_id"), 5) != 0)
    rows = [(r.doc_id, r.text) for r in docs_of.collect()]
    rows = [(i, t) for i, t in rows if 1 / (1 + math.exp(model.thresholds[0] - model.quality(t or ""))) >= quality_classifier.KEEP]
    rows = [(i, c) for i, t in rows if (c := cleaned(t)) is not None]
    groups = similar_groups(rows)
    first = {}
    for k, (i, _) in enumerate(rows):
        first[groups[k]] = min(i, first.get(groups[k], i))
    rows = [(i, masked(t)) for k, (i, t) in enumerate(rows) if first[groups[k]] == i]
    want, lengths = Counter(), []
    for i, t in rows:
        ids, start = ids_of(t), 0
        for k, n in enumerate(packing.cut_lengths(len(ids), 1024)):
            want[i, k, start, n, zlib.crc32(np.array(ids[start : start + n], "<u4").tobytes())] += 1
            lengths.append(n)
            start += n
    got = corpus_pipeline.run(spark, sf).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    assert valid(got, 1024) == best_fit(lengths, 1024)


LONG = " ".join(f"Sentence number {k} says something else about the town and its {k * 7} people." for k in range(3000))


def test_awkward_documents_pass_each_stage(spark):
    """Each stage keeps columns and makes no rows; redaction loses none, packing holds all tokens."""
    rows = [*AWKWARD, (50, LONG), (51, LONG)]
    df = docs(spark, rows, row=1, own="o", node=2)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns, name
        got, all_ids = Counter(r.doc_id for r in out.collect()), Counter(i for i, _ in rows)
        assert got <= all_ids, name
        if name.startswith("secret"):
            assert got == all_ids
        if name.startswith("simhash"):
            assert got == Counter([1, 2, 5, 6, None, 8, 50])
        assert stage(spark, docs(spark, []), SF).collect() == []
    pieces = corpus_pipeline.STAGES[-1][1](spark, df, SF).collect()
    assert sum(r.length for r in pieces) == sum(len(ids_of(t)) for _, t in rows)
    assert corpus_pipeline.STAGES[-1][1](spark, docs(spark, []), SF).collect() == []
