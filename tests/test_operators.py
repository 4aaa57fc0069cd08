"""Edge cases of the operators, sources, sinks and streaming."""

import json
import os
import shutil
import subprocess
import sys
import zipfile
from pathlib import Path

import pytest
from lattica.functions import scalars as S
from lattica.operators import catalogue, dataflow, guards, params, report, sheet, spatial, versions
from lattica.sinks import writers
from lattica.sources import readers
from lattica.streaming import ingest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

SHEET = "line long, sample string, fastq_1 string, fastq_2 string, extra string"


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(k) for k, c in cols.items()]).first()


def test_sheet_of_the_fixtures(spark):
    rows = [(0, "A B", "x_1.fastq.gz", "x_2.fastq.gz", "k"), (1, "A B", "y_1.fastq.gz", "", None), (2, "C", "z.fq.gz", None, "")]
    out = sheet.validated(spark.createDataFrame(rows, SHEET)).orderBy("line")
    assert out.columns == ["line", "sample", "single_end", "fastq_1", "fastq_2", "extra"]
    assert [(r.sample, r.single_end) for r in out.collect()] == [("A_B_T1", False), ("A_B_T2", True), ("C_T1", True)]


@pytest.mark.parametrize("row,error", [
    (("", "a.fq.gz", ""), "Sample input"), ((" ", "a.fq.gz", ""), None), (("D", "", ""), "At least the first"), (("D", "d.txt", ""), "unrecognized extension: d.txt"),
    (("D", "d.FQ.GZ", ""), "unrecognized"), (("E", "e_1.fq.gz", "e_2.fastq.gz"), "same file extensions"), (("E", "e_1.fq.gz", "e.bam"), "unrecognized extension: e.bam"), (("E", ".fq.gz", "e.fq.gz"), "same file extensions"),
])
def test_row_errors(spark, row, error):
    found = sheet.errors(spark.createDataFrame([(0, *row, None)], SHEET)).collect()
    assert (error in found[0].error) if error else not found


def test_strict_sheet_tells_the_first_line(spark):
    bad = spark.createDataFrame([(0, "A", "a.fq.gz", "", ""), (3, "", "a.fq.gz", "", ""), (1, "B", "b.txt", "", "")], SHEET)
    with pytest.raises(PySparkException, match="b.txt On line 3"):
        sheet.strict(bad).collect()
    twice = spark.createDataFrame([(0, "F", "f.fq.gz", "g.fq.gz", ""), (1, "F", "f.fq.gz", "h.fq.gz", "")], SHEET)
    with pytest.raises(PySparkException, match="must be unique"):
        sheet.strict(twice).collect()
    assert sheet.strict(bad.where("line = 0")).count() == 1
    with pytest.raises(ValueError, match="fastq_2"):
        sheet.require_columns(bad.drop("fastq_2"))


def test_sheet_files(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text('sample\tfastq_1\tfastq_2\nA B\ta.fastq.gz\t\n\n"C"\tc_1.fastq.gz\tc_2.fastq.gz\n')
    df = readers.sheet(spark, str(p), sep="\t")
    assert [tuple(r) for r in df.orderBy("line").collect()] == [(0, "A B", "a.fastq.gz", ""), (1, "C", "c_1.fastq.gz", "c_2.fastq.gz")]
    writers.write_sheet(sheet.validated(df), str(tmp_path / "out"))
    again = readers.split_csv(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, again.collect())) == [("A_B_T1", "True", "a.fastq.gz", ""), ("C_T1", "False", "c_1.fastq.gz", "c_2.fastq.gz")]
    assert sorted(r.n for r in sheet.reads(again).select(F.size("reads").alias("n")).collect()) == [1, 2]
    (tmp_path / "short.csv").write_text("sample,fastq_1\nA\n")
    with pytest.raises(PySparkException):
        readers.sheet(spark, str(tmp_path / "short.csv"), sep=",").collect()


def test_sniffing(spark, tmp_path):
    p = tmp_path / "s.csv"
    p.write_text("sample;count;fastq_1\nA;1;a.fastq.gz\nB;22;b.fastq.gz\nC;333;c.fastq.gz\n")
    assert readers.sniffed(spark, str(p)).delimiter == ";"


def test_truth(spark):
    r = one(spark, a=S.truthy(F.lit("")), b=S.truthy(F.lit(0), "int"), c=S.truthy(F.lit(None).cast("string")), d=S.truthy(F.array().cast("array<string>"), "array<string>"), e=S.truthy(F.lit("0")), f=S.flag("n", F.lit(0), "int"), g=S.flag("n", F.lit(0), "int", zero_is_value=True), h=S.or_else(F.lit(""), F.lit("x")), i=S.truthy(F.lit(False), "boolean"))
    assert tuple(r) == (False, False, False, False, True, "", "--n=0", "x", False)


def test_scalars(spark):
    r = one(spark, a=S.amount(F.lit("6.GB"), "memory"), b=S.amount(F.lit("1.5 h"), "time"), c=S.amount(F.lit("lots"), "memory"), d=S.capped(F.lit(5), F.lit(None).cast("int")), e=S.day_unit(F.lit("3d 2h")), f=S.publish_path(F.lit("A:B:MULTI_TOOL_X")), g=S.pad_right(F.lit("abcdef"), F.lit(3)), h=S.base_name(F.lit("a.b.tif")), i=S.colour(F.lit("red"), F.lit(True)), j=S.colour(F.lit("red"), F.lit(False)), k=S.attached(F.lit(5), F.lit(5)), l=S.attached(F.lit(5), F.lit(5), True), m=F.array_join(S.tokens(F.lit("a,,b,")), "|"), n=S.to_boolean(F.lit("True")))
    assert tuple(r) == (6 * 1024**3, 5400, None, 5, "3day 2h", "multi", "abcdef", "a.b", "", "\033[0;31m", False, True, "a|b", True)


def test_wrapping(spark):
    text = "one two three four five six seven"
    want, line = [], ""
    for w in text.split(" "):
        if len(line) + len(w) <= 10:
            line += w + " "
        else:
            want.append(line)
            line = w + " "
    r = one(spark, a=S.wrapped(F.lit(text), 10), b=S.wrapped(F.lit("short"), 10))
    assert list(r.a) == [*want, line] and list(r.b) == ["short"]


SCHEMA = {"definitions": {"io": {"title": "Input", "required": ["input"], "properties": {"input": {"type": "string", "pattern": "^.*csv$", "description": "a sheet"}, "max": {"type": "integer", "default": "3", "hidden": True}}}}, "properties": {"mode": {"type": "string", "enum": ["a", "b"]}}}


def test_parameter_schema(spark, tmp_path):
    p = tmp_path / "schema.json"
    p.write_text(json.dumps(SCHEMA))
    schema = readers.parameter_schema(spark, str(p))
    rows = {r.name: r for r in schema.collect()}
    assert rows["input"].required and rows["input"].grp == "Input" and rows["max"].hidden and rows["mode"].grp == "Other parameters" and list(rows["mode"].enum) == ["a", "b"]
    given = spark.createDataFrame([("mode", "c"), ("max", "x"), ("input", "s.txt")], "name string, value string")
    errors = {r.name: r.error for r in params.violations(given, schema).collect()}
    assert errors == {"mode": "* --mode: 'c' is not a valid choice (Available choices: a, b)", "max": "* --max: expected type: integer (x)", "input": "* --input: does not match pattern ^.*csv$ (s.txt)"}
    assert [r.error for r in params.violations(given.where("false"), schema).collect()] == ["* Missing required parameter: --input"]
    text = {r.name: r.text for r in params.help_lines(schema, 40).collect()}
    assert set(text) == {"input", "mode"} and text["input"].startswith("  --input[string]  a sheet")
    assert set(params.without_ignored(schema, spark.createDataFrame([("mode",)], "name string")).toPandas()["name"]) == {"input", "max"}


def test_cleaned_values(spark):
    rows = [("a", "0", "integer"), ("b", "", "string"), ("c", None, "string"), ("d", "false", "boolean"), ("e", "2d", "duration"), ("f", "0", "string"), ("g", "true", "boolean")]
    out = params.cleaned(spark.createDataFrame(rows, "name string, value string, type string"))
    assert sorted((r.name, r.value) for r in out.collect()) == [("e", "2day"), ("f", "0"), ("g", "true")]


def test_versions(spark, tmp_path):
    (tmp_path / "a.yml").write_text('"F:SUB:QC":\n    tool: 1.10\n    other: "2"\n')
    (tmp_path / "b.yml").write_text('F:MULTI:QC:\n    tool: 1.10\n    other: 2 # note\nF:X:\n    t: 3\n')
    v = readers.version_documents(spark, str(tmp_path))
    assert sorted(map(tuple, v.collect())) == [("F:MULTI:QC", "other", "2"), ("F:MULTI:QC", "tool", "1.10"), ("F:SUB:QC", "other", "2"), ("F:SUB:QC", "tool", "1.10"), ("F:X", "t", "3")]
    assert versions.inconsistent(v).count() == 0
    assert sorted(map(tuple, versions.modules(v).collect())) == [("QC", "other", "2"), ("QC", "tool", "1.10"), ("X", "t", "3")]
    worse = v.unionByName(spark.createDataFrame([("F:Z:X", "t", "4")], "process string, tool string, version string"))
    assert [r.module for r in versions.inconsistent(worse).collect()] == ["X"]
    with pytest.raises(PySparkException, match="same between"):
        versions.modules(worse).collect()


def test_catalogue_files(spark, tmp_path):
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"G1": {"fasta": "a.fa", "size": "3e9"}, "G2": {"fasta": "b.fa"}}))
    c = readers.catalogue(spark, str(p))
    rows = spark.createDataFrame([("G1",), ("G3",), ("",)], "g string")
    assert {r.g: r.size for r in catalogue.lookup(rows, c, "g", "size", "size").collect()} == {"G1": "3e9", "G3": None, "": None}
    with pytest.raises(PySparkException, match="'G3' not found. Available: G1, G2"):
        catalogue.require_known(rows, c, "g").collect()
    assert catalogue.require_known(rows.where("g <> 'G3'"), c, "g").count() == 2


def test_files_bundles_and_archives(spark, tmp_path):
    root = tmp_path / "bundle"
    (root / "outs" / "deep").mkdir(parents=True)
    (root / "outs" / "deep" / "a_masks.tif").write_bytes(b"x")
    (root / "b.csv").write_bytes(b"yy")
    assert sorted(map(tuple, readers.bundle(spark, str(root)).select("name", "length").collect())) == [("b.csv", 2), ("outs/deep/a_masks.tif", 1)]
    assert readers.bundle(spark, str(root), "nothing").count() == 0
    assert readers.files(spark, str(root), "*masks.tif").count() == 1
    with pytest.raises(PySparkException):
        readers.files(spark, str(tmp_path / "absent")).count()
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("in/m.txt", "hello")
    assert [(r.name, bytes(r.content)) for r in readers.unpacked(spark, str(tmp_path / "z.zip")).collect()] == [("in/m.txt", b"hello")]
    with pytest.warns(UserWarning, match="optional layer"):
        assert readers.optional_layer(lambda: readers.files(spark, str(tmp_path / "absent")), spark.range(2)).count() == 2


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    writers.collect_file(df, "v", str(tmp_path / "c"), "k")
    assert "".join(p.read_text() for p in (tmp_path / "c").glob("part-*")) == "a\nb\n"
    out = spark.createDataFrame([("X:TOOL_A", "r.txt"), ("X:TOOL_B", "versions.yml"), ("Y:OTHER", "a_versions.yml")], "process string, name string")
    writers.publish(out, str(tmp_path / "p"))
    assert {p.name for p in (tmp_path / "p").iterdir() if p.is_dir()} == {"folder=tool", "folder=other"}
    assert writers.version_files(out).count() == 1
    sent = []
    assert writers.deliver({"a": 1, "hook_url": "secret"}, lambda s: sent.append(s) or 200) and "secret" not in sent[0]
    with pytest.warns(UserWarning):
        assert not writers.deliver({}, lambda s: 500)


def test_channels(spark):
    assert dataflow.collected(dataflow.empty(spark, "a int"), "a").first().items == []


def test_hulls_and_shells(spark, tmp_path):
    import numpy as np

    rows = [(1, float(x), float(y)) for x in range(5) for y in range(5)] + [(2, 0.0, 0.0), (2, 1.0, 1.0), (2, 0.5, 0.5), (3, 4.0, 4.0), (None, 9.0, 9.0)]
    got = {r.cell_id: [(p.x, p.y) for p in r.ring] for r in spatial.hulls(spark.createDataFrame(rows, "cell_id long, x double, y double").repartition(4)).collect()}
    assert got[1] == [(0, 0), (4, 0), (4, 4), (0, 4)] and got[2] == [(0, 0), (1, 1)] and got[3] == [(4, 4)] and set(got) == {1, 2, 3}
    mask = np.zeros((5, 5))
    mask[0, :2] = mask[3:, 4] = 1
    np.save(tmp_path / "m.npy", mask)
    out = report.process_shell(readers.files(spark, str(tmp_path), "*.npy", content=True), report.components_of_mask, "path string, label int, n int, cx double, cy double")
    assert sorted((r.label, r.n, r.cx, r.cy) for r in out.collect()) == [(1, 2, 0.5, 0.0), (2, 2, 4.0, 3.5)]
    assert report.stub(spark, {"t": "a int"})["t"].count() == 0
    features = spark.createDataFrame([("cell", 1, "g", "n"), ("cell", 2, "g", None), ("other", 3, "g", "n")], "objectType string, cell_id int, geometry string, nucleusGeometry string")
    assert sorted(map(tuple, spatial.segmented_features(features).collect())) == [(1, "n"), (2, "g")]
    assert spatial.wide(spatial.counts(spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "cell_id int, gene string")), ["a", "b"]).orderBy("cell_id").first().a == 2
    assert spatial.prepared(spark.createDataFrame([(1, None, 5, 0.0, 0.0)], "transcript_id int, cell_id int, gene int, x double, y double")).first().is_noise


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("sample,fastq_1,fastq_2\nA B,a.fq.gz,\nX,x.txt,\n")
    ended = []
    listener = ingest.OnComplete(lambda i, e: ended.append(e))
    spark.streams.addListener(listener)
    q = ingest.checked(ingest.sheets(spark, str(tmp_path / "in"))).writeStream.format("memory").queryName("landed").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = {r.sample: r for r in spark.table("landed").collect()}
    assert rows["A_B"].single_end and rows["A_B"].error is None and "x.txt" in rows["X"].error
    (tmp_path / "ev").mkdir()
    (tmp_path / "ev" / "e.json").write_text('{"ts":"2024-01-01T00:00:01Z","k":"a"}\n{"ts":"2024-01-01T00:00:09Z","k":"a"}\n')
    events = spark.readStream.schema("ts timestamp, k string").json(str(tmp_path / "ev"))
    q = ingest.event_counts(events, "ts", "k", "10 seconds", "1 minute").writeStream.format("memory").outputMode("complete").queryName("counted").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [r.n for r in spark.table("counted").collect()] == [2]
    spark.streams.removeListener(listener)


def test_entry_point(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 1500
    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_point_without_the_training_data_operators(tmp_path):
    """With their folders and the pipeline deleted the rest imports, and keeps its queries; another missing module is told."""
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "lattica", tmp_path / "lattica", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)

    def run(code):
        return subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120, env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})

    out = run("import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(n.startswith('op') or n == 'pipeline' for n in e.queries()))")
    assert out.returncode == 0, out.stderr
    from lattica.plans.queries import ORACLES, QUERIES

    assert out.stdout.split() == [str(len(QUERIES)), str(len(ORACLES)), "False"]
    (tmp_path / "corpus_pipeline.py").write_text("import a_module_that_is_not_there\n")
    assert "a_module_that_is_not_there" in run("import __spark_entry__ as e; e.queries()").stderr


def test_a_row_error_is_told_before_duplicates(spark):
    both = spark.createDataFrame([(0, "F", "f.txt", "", ""), (1, "F", "f.txt", "", "")], SHEET)
    with pytest.raises(PySparkException, match="unrecognized extension"):
        sheet.strict(both).collect()


def test_combine_with_a_side_of_any_size(spark):
    left = dataflow.of(spark, [(1,), (2,)], "a int")
    assert dataflow.combine(left, spark.range(dataflow.MAX_SIDE_ROWS + 1)).count() == 2 * (dataflow.MAX_SIDE_ROWS + 1)
    assert dataflow.combine(left, spark.range(0)).count() == 0


def test_lists_and_guards_of_nulls(spark):
    none = F.lit(None).cast("array<string>")
    got = one(spark, a=dataflow.appended(none, F.lit("x")), b=guards.any_of(none, F.array(F.lit("x"))), c=guards.barred_profile(F.lit(None).cast("string"), F.lit("S")), d=guards.batch_problem(F.lit(None).cast("string"), F.lit("q"), F.lit("r"), F.lit("o")))
    assert got.a == ["x"] and got.b is False and got.c is None and got.d is None


def test_regions_of_a_mask():
    import io

    import numpy as np
    import pandas as pd

    rng = np.random.default_rng(0)
    mask = rng.random((30, 40)) < 0.55
    content = io.BytesIO()
    np.save(content, mask)
    (got,) = report.components_of_mask([pd.DataFrame({"path": ["m"], "content": [content.getvalue()]})])
    left, want = set(zip(*np.nonzero(mask))), []
    for start in sorted(left):
        if start in left:
            left.discard(start)
            region, edge = [], [start]
            while edge:
                i, j = edge.pop()
                region.append((i, j))
                for p in ((i + 1, j), (i - 1, j), (i, j + 1), (i, j - 1)):
                    if p in left:
                        left.discard(p)
                        edge.append(p)
            want.append((len(region), *np.mean(region, axis=0)[::-1]))
    assert got["n"].tolist() == [n for n, _, _ in want]
    assert np.allclose(got[["cx", "cy"]], [w[1:] for w in want])


def test_shared_folder_is_needed_beyond_local_mode():
    from types import SimpleNamespace

    from lattica.sources import shared

    cluster = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(cluster)
