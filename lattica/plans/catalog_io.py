"""Queries of sources, sinks and streams: each writes small files of its own to the shared folder and reads them back."""

from __future__ import annotations

import io
import json
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.operators import report, sheet
from lattica.plans.catalog import sheet_of
from lattica.plans.registry import query
from lattica.sinks import writers
from lattica.sources import readers
from lattica.sources.readers import load
from lattica.sources.shared import new_path
from lattica.streaming import ingest


def nations(spark: SparkSession, d: str) -> list:
    """The 25 nations with their region, in order."""
    j = load(spark, d, "nation").join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.orderBy("n_nationkey").collect()


def by_region(spark: SparkSession, d: str) -> dict[str, list]:
    out: dict[str, list] = {}
    for r in nations(spark, d):
        out.setdefault(r.r_name, []).append(r)
    return out


@query("SELECT row_number() OVER (ORDER BY n_nationkey) - 1 AS line, 'n ' || n_name AS sample, n_nationkey::VARCHAR AS size, CASE WHEN n_nationkey % 2 = 0 THEN '' ELSE 'a;b' END AS note FROM nation")
def sheet_sniffed(spark, d):  # noqa: ANN001, ANN201
    path = new_path(spark, "sheet") + "/sheet.csv"
    rows = [f"n {r.n_name};{r.n_nationkey};" + ("" if r.n_nationkey % 2 == 0 else '"a;b"') for r in nations(spark, d)]
    writers.write_file(spark, path, "\n".join(["sample;size;note", *rows[:9], "", *rows[9:]]) + "\n")
    return readers.sheet(spark, path)


@query("SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus, o_orderpriority FROM orders")
def sheet_split(spark, d):  # noqa: ANN001, ANN201
    path = new_path(spark, "split")
    load(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority").write.csv(path, header=True, sep=";")
    return readers.split_csv(spark, path, ";")


@query("SELECT 'outs/' || r_name || '/masks.tif' AS name, length(r_name) AS length FROM region")
def bundle_members(spark, d):  # noqa: ANN001, ANN201
    path = new_path(spark, "bundle")
    for name in by_region(spark, d):
        for member in ("masks.tif", "flows.txt"):
            writers.write_file(spark, f"{path}/outs/{name}/{member}", name)
    return readers.bundle(spark, path, "^outs/.*masks[.]tif$").select("name", "length")


@query("""SELECT r_name AS grp, 'about ' || n_name AS title, lower(n_name) AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'string' ELSE 'integer' END AS type, CASE WHEN n_nationkey % 3 = 0 THEN n_nationkey::VARCHAR END AS "default",
  CASE WHEN n_nationkey % 4 = 0 THEN 'a, b' ELSE '' END AS enum, n_nationkey % 5 = 0 AS hidden, n_nationkey % 2 = 0 AS required FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT 'Other parameters', NULL, 'extra', 'boolean', NULL, '', false, true""")
def schema_loaded(spark, d):  # noqa: ANN001, ANN201
    def prop(r) -> dict:  # noqa: ANN001
        k = r.n_nationkey
        more = {"default": str(k)} if k % 3 == 0 else {}
        return {"type": "integer" if k % 2 else "string", "description": f"about {r.n_name}", **more, **({"enum": ["a", "b"]} if k % 4 == 0 else {}), **({"hidden": True} if k % 5 == 0 else {})}

    groups = {name.lower(): {"title": name, "required": [r.n_name.lower() for r in rows if r.n_nationkey % 2 == 0], "properties": {r.n_name.lower(): prop(r) for r in rows}} for name, rows in by_region(spark, d).items()}
    path = new_path(spark, "schema") + "/schema.json"
    writers.write_file(spark, path, json.dumps({"definitions": groups, "required": ["extra"], "properties": {"extra": {"type": "boolean"}}}))
    return readers.parameter_schema(spark, path).select("grp", "title", "name", "type", "default", F.array_join("enum", ", ").alias("enum"), "hidden", "required")


@query("SELECT r_name AS process, n_name AS tool, '0' || n_nationkey || '.10' AS version FROM nation JOIN region ON n_regionkey = r_regionkey")
def version_documents(spark, d):  # noqa: ANN001, ANN201
    path = new_path(spark, "versions")
    for name, rows in by_region(spark, d).items():
        writers.write_file(spark, f"{path}/{name}_versions.yml", f'"{name}":\n' + "".join(f"  {r.n_name}: 0{r.n_nationkey}.10  # a comment\n" for r in rows))
    return readers.version_documents(spark, path)


@query("SELECT n_name AS key, attr, CASE attr WHEN 'region' THEN n_regionkey ELSE n_nationkey END::VARCHAR AS value FROM nation, (VALUES ('region'), ('size')) a(attr)")
def catalogue_read(spark, d):  # noqa: ANN001, ANN201
    path = new_path(spark, "catalogue") + "/genomes.json"
    writers.write_file(spark, path, json.dumps({r.n_name: {"region": str(r.n_regionkey), "size": str(r.n_nationkey)} for r in nations(spark, d)}))
    return readers.catalogue(spark, path)


@query("SELECT n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'own' ELSE 'base' END || n_nationkey AS value FROM nation")
def config_layers(spark, d):  # noqa: ANN001, ANN201
    path, rows = new_path(spark, "config"), nations(spark, d)
    writers.write_file(spark, f"{path}/base.json", json.dumps({r.n_name: f"base{r.n_nationkey}" for r in rows}))
    writers.write_file(spark, f"{path}/own.json", json.dumps({r.n_name: f"own{r.n_nationkey}" for r in rows if r.n_nationkey % 2 == 0}))
    return readers.layered(spark, [(f"{path}/base.json", False), (f"{path}/absent.json", True), (f"{path}/own.json", True)])


@query("SELECT n_nationkey, 'Dear ' || n_name || ',' || chr(10) || 'all the best from ' || r_name || '.' AS text FROM nation JOIN region ON n_regionkey = r_regionkey")
def template_filled(spark, d):  # noqa: ANN001, ANN201
    from lattica.functions import scalars as S

    path = new_path(spark, "template") + "/mail.txt"
    writers.write_file(spark, path, "Dear ${who},\nall the best from ${where}.")
    j = load(spark, d, "nation").join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).crossJoin(F.broadcast(readers.templates(spark, path)))  # one template
    return j.select("n_nationkey", S.substituted(F.col("value"), {"who": F.col("n_name"), "where": F.col("r_name")}).alias("text"))


@query("SELECT r_name || '/' || n_name || '.txt' AS name, n_name AS content FROM nation JOIN region ON n_regionkey = r_regionkey")
def archive_members(spark, d):  # noqa: ANN001, ANN201
    path, buffer = new_path(spark, "archive") + "/bundle.zip", io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        for r in nations(spark, d):
            z.writestr(f"{r.r_name}/{r.n_name}.txt", r.n_name)
    writers.write_file(spark, path, buffer.getvalue())
    return readers.unpacked(spark, path).select("name", F.col("content").cast("string").alias("content"))


@query("""SELECT replace(sample, ' ', '_') || '_T' || row_number() OVER (PARTITION BY sample ORDER BY line) AS sample, CASE WHEN fastq_2 = '' THEN 'True' ELSE 'False' END AS single_end, fastq_1, fastq_2
  FROM (SELECT o_orderkey AS line, 'cust ' || o_custkey AS sample, 'run_' || o_orderkey || '.fastq.gz' AS fastq_1, CASE WHEN o_orderstatus = 'F' THEN 'run_' || o_orderkey || '_2.fastq.gz' ELSE '' END AS fastq_2 FROM orders)""")
def sheet_written(spark, d):  # noqa: ANN001, ANN201
    path = new_path(spark, "written")
    writers.write_sheet(sheet.validated(sheet_of(spark, d)), path)
    return readers.split_csv(spark, path)


@query("SELECT row_number() OVER (ORDER BY n_name DESC) - 1 AS pos, n_name AS value FROM nation")
def collected_file(spark, d):  # noqa: ANN001, ANN201
    path = new_path(spark, "collected")
    rows = load(spark, d, "nation").withColumn("at", F.row_number().over(_by_name()))
    writers.collect_file(rows, "n_name", path, "at")
    lines = F.split(F.rtrim(F.regexp_replace("value", "\n$", "")), "\n")
    return spark.read.text(path, wholetext=True).select(F.posexplode(lines).alias("pos", "value")).select(F.col("pos").cast("long"), "value")


def _by_name():  # noqa: ANN202
    from pyspark.sql import Window

    return Window.orderBy(F.desc("n_name"))


@query("SELECT n_name AS process, 'tool' || t AS tool, n_regionkey || '.' || t AS version FROM nation, range(3) r(t)")
def version_table_appended(spark, d):  # noqa: ANN001, ANN201
    path = new_path(spark, "version-table")
    for t in range(3):
        writers.append_versions(load(spark, d, "nation").select(F.col("n_name").alias("process"), F.lit(f"tool{t}").alias("tool"), F.concat(F.col("n_regionkey").cast("string"), F.lit(f".{t}")).alias("version")), path)
    return spark.read.parquet(path)


@query("SELECT 'pipeline_report.html' AS name, '<p>' || count(*) || ' nations</p>' AS value FROM nation UNION ALL SELECT 'pipeline_report.txt', count(*) || ' nations' FROM nation")
def reports_written(spark, d):  # noqa: ANN001, ANN201
    path, n = new_path(spark, "reports"), len(nations(spark, d))
    writers.write_reports(spark, path, f"<p>{n} nations</p>", f"{n} nations")
    files = spark.read.text(path, wholetext=True)
    return files.select(F.regexp_extract("_metadata.file_path", "[^/]*$", 0).alias("name"), "value")


@query("""SELECT r_regionkey, CASE WHEN r_regionkey % 2 = 0 THEN 'mail' ELSE 'web' END AS hook, r_regionkey % 3 <> 0 AS delivered, '_hidden_' AS shown FROM region""")
def hooks_called(spark, d):  # noqa: ANN001, ANN201
    import warnings

    sent: list[str] = []

    def hook(payload: str) -> int:
        sent.append(payload)
        return 200 if json.loads(payload)["r_regionkey"] % 3 else 500

    out = []
    for r in load(spark, d, "region").orderBy("r_regionkey").collect():
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            kind = "web" if r.r_regionkey % 2 else "mail"
            ok = writers.deliver({"r_regionkey": r.r_regionkey, "kind": kind, "hook_url": "https://example.org/x"}, hook)
        told = json.loads(sent[-1])
        out.append((r.r_regionkey, told["kind"], ok, told["hook_url"]))
    return spark.createDataFrame(out, "r_regionkey int, hook string, delivered boolean, shown string")


@query("SELECT row_number() OVER (ORDER BY n_regionkey)::INT AS label, count(*) AS n, (count(*) - 1) / 2.0::DOUBLE AS cx, (2 * n_regionkey)::DOUBLE AS cy FROM nation GROUP BY n_regionkey")
def mask_regions(spark, d):  # noqa: ANN001, ANN201
    import numpy as np

    rows = list(by_region(spark, d).values())
    mask = np.zeros((12, 30), dtype=np.uint8)
    for own in rows:
        mask[2 * own[0].n_regionkey, : len(own)] = 1
    path, buffer = new_path(spark, "mask") + "/mask.npy", io.BytesIO()
    np.save(buffer, mask)
    writers.write_file(spark, path, buffer.getvalue())
    found = report.process_shell(readers.files(spark, path, content=True), report.components_of_mask, "path string, label int, n long, cx double, cy double")
    return found.drop("path")


@query("SELECT * FROM (VALUES ('masks', 0::BIGINT, 'path,label'), ('versions', 0::BIGINT, 'process,tool,version')) t(name, n, columns)")
def stub_outputs(spark, d):  # noqa: ANN001, ANN201
    out = report.stub(spark, {"masks": "path string, label int", "versions": "process string, tool string, version string"})
    parts = [df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"), F.lit(",".join(df.columns)).alias("columns")) for name, df in out.items()]
    return parts[0].unionByName(parts[1])


def _streamed(stream: DataFrame, mode: str = "append") -> DataFrame:
    """What a stream gives for all that has landed, as a table."""
    import uuid

    spark, name = stream.sparkSession, f"landed_{uuid.uuid4().hex}"
    stream.writeStream.format("memory").outputMode(mode).queryName(name).trigger(availableNow=True).start().awaitTermination()
    return spark.table(name)


@query("SELECT 'cust_' || c_custkey AS sample, c_custkey % 2 = 0 AS single_end, CASE WHEN c_custkey % 10 = 0 THEN 'The FASTQ file has an unrecognized extension: x.txt' END AS error FROM customer")
def stream_sheets(spark, d):  # noqa: ANN001, ANN201
    path, k = new_path(spark, "landing"), F.col("c_custkey")
    rows = load(spark, d, "customer").select(F.concat(F.lit("cust "), k.cast("string")).alias("sample"), F.when(k % 10 == 0, "x.txt").otherwise("a.fq.gz").alias("fastq_1"), F.when(k % 2 == 0, "").otherwise("b.fq.gz").alias("fastq_2"))
    rows.repartition(3).write.csv(path, header=True)
    return _streamed(ingest.checked(ingest.sheets(spark, path)).select("sample", "single_end", "error"))


@query("SELECT event_type, time_bucket(INTERVAL '1 hour', ts) AS start, count(*) AS n FROM events GROUP BY ALL")
def stream_event_counts(spark, d):  # noqa: ANN001, ANN201
    path = new_path(spark, "events")
    load(spark, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_type").write.parquet(path)
    stream = spark.readStream.schema("ts timestamp, event_type string").parquet(path)
    counted = _streamed(ingest.event_counts(stream, "ts", "event_type", "1 hour", "1 day"), "complete")
    return counted.select("event_type", F.col("window.start").cast("timestamp_ntz").alias("start"), "n")


@query("SELECT 1::BIGINT AS ended, true AS well")
def stream_completion(spark, d):  # noqa: ANN001, ANN201
    import time

    ended: list[str | None] = []
    listener = ingest.OnComplete(lambda _, error: ended.append(error))
    spark.streams.addListener(listener)
    try:
        path = new_path(spark, "one")
        load(spark, d, "region").write.parquet(path)
        _streamed(spark.readStream.schema(load(spark, d, "region").schema).parquet(path))
        for _ in range(100):  # the callback comes a moment after the end
            if ended:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    return spark.createDataFrame([(len(ended), ended == [None])], "ended long, well boolean")
