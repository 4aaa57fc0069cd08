"""More queries: guards, extensions, resuming, messages, reports and scalars."""

from __future__ import annotations

from pyspark.sql import functions as F

from lattica.functions import scalars as S
from lattica.operators import dataflow, guards, params, report, spatial, versions
from lattica.plans.catalog import _NEAREST, _POINTS, assigned_of, points_of
from lattica.plans.registry import query
from lattica.sinks import writers
from lattica.sources.readers import load


@query("""SELECT event_id, CASE WHEN event_type IN ('click', 'error') THEN 'STEP' || event_id % 7 || ' does not run under conda or mamba; use a container profile' END AS conda,
  CASE WHEN event_id % 4 <> 1 THEN NULL WHEN event_id % 3 = 0 OR event_id % 5 = 0 THEN 'a batch run needs --awsqueue and --awsregion' WHEN event_id % 2 = 0 OR event_id % 7 <> 0 THEN 'a batch run needs --outdir in s3:' END AS batch,
  event_id % 4 = 0 AND event_id % 3 <= 1 AS unconfigured FROM events""")
def run_guards(spark, d):  # noqa: ANN001, ANN201
    k, t = F.col("event_id"), F.col("event_type")
    profile = F.when(t == "click", "test,conda").when(t == "error", "mamba").when(t == "view", "condax,docker").when(t == "purchase", "")
    batch = F.when(k % 4 == 0, "standard").when(k % 4 == 1, "awsbatch,test").otherwise("docker")
    return load(spark, d, "events").select(
        k,
        guards.barred_profile(profile, F.concat(F.lit("STEP"), (k % 7).cast("string"))).alias("conda"),
        guards.batch_problem(batch, F.when(k % 3 != 0, "queue"), F.when(k % 5 == 0, "").otherwise("region"), F.when(k % 7 == 0, "s3://bucket/out").otherwise("out")).alias("batch"),
        guards.unconfigured(batch, k % 3).alias("unconfigured"),
    )


@query("SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN '' ELSE '--boundary-stain=disable' END AS boundary, CASE WHEN p_size % 2 = 0 THEN '--interior-stain=disable' ELSE '' END AS interior FROM part")
def stain_flags(spark, d):  # noqa: ANN001, ANN201
    size = F.col("p_size")
    return load(spark, d, "part").select("p_partkey", guards.stain_flag("boundary-stain", F.when(size % 3 == 0, "").otherwise(F.col("p_brand"))).alias("boundary"), guards.stain_flag("interior-stain", F.when(size % 2 == 0, "disable")).alias("interior"))


@query("""SELECT conv_id, list_has_any(r, ['system', 'tool']) AS some, len(r) + 2 AS n, r[-1] || ',x,y' AS tail FROM (SELECT conv_id, list(role ORDER BY turn, role) AS r FROM conversations GROUP BY conv_id)""")
def list_append_and_any(spark, d):  # noqa: ANN001, ANN201
    # conversations are short by nature: their roles stand for a list
    roles = load(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role"))), lambda s: s["role"]).alias("r"))
    longer = dataflow.appended(F.col("r"), F.lit("x"), F.lit("y"))
    return roles.select("conv_id", guards.any_of(F.col("r"), F.array(F.lit("system"), F.lit("tool"))).alias("some"), F.size(longer).cast("long").alias("n"), F.array_join(F.slice(longer, -3, 3), ",").alias("tail"))


@query("""SELECT event_id AS id, CASE event_id % 4 WHEN 0 THEN '* Missing required parameter: --' || event_type WHEN 1 THEN '* ' || event_type || ' failed'
  WHEN 2 THEN '* --p' || event_id % 40 || ': ''v' || event_id % 40 || ''' is not a valid choice (Available choices: a, b)' ELSE '* --p' || event_id % 40 || ': expected type: Integer (' || CASE WHEN event_id % 40 = 39 THEN 'null' ELSE 'v' || event_id % 40 END || ')' END AS error FROM events""")
def error_messages(spark, d):  # noqa: ANN001, ANN201
    k, t = F.col("event_id"), F.col("event_type")
    name = F.concat(F.lit("p"), (k % 40).cast("string"))
    message = F.when(k % 4 == 0, F.concat(F.lit("required key ["), t, F.lit("] not found"))).when(k % 4 == 1, F.concat(t, F.lit(" failed"))).otherwise("expected type: Integer")
    leaves = load(spark, d, "events").select(k.alias("id"), message.alias("message"), F.when(k % 4 <= 1, "#").otherwise(F.concat(F.lit("#/"), name)).alias("pointer"))
    given = spark.range(39).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("name"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("value"))
    enums = spark.range(2, 40, 4).select(F.concat(F.lit("p"), F.col("id").cast("string")).alias("name"), F.array(F.lit("a"), F.lit("b")).alias("enum"))
    return params.error_messages(leaves, given, enums)


@query("SELECT p_brand AS grp, string_agg('p' || p_partkey, ',' ORDER BY p_partkey) FILTER (p_size % 5 <> 0) AS required, count(*) FILTER (p_size % 5 <> 0) AS n FROM part WHERE p_partkey <= 2000 GROUP BY 1")
def params_ignored(spark, d):  # noqa: ANN001, ANN201
    name = F.concat(F.lit("p"), F.col("p_partkey").cast("string"))
    p = load(spark, d, "part").where("p_partkey <= 2000")  # a schema is small by nature
    schema, ignore = p.select(F.col("p_brand").alias("grp"), name.alias("name"), F.col("p_partkey").alias("at")), p.where("p_size % 5 = 0").select(name.alias("name"))
    left = params.without_ignored(schema, ignore).groupBy("grp").agg(F.count(F.lit(1)).alias("n"))
    lists = schema.groupBy("grp").agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "name"))), lambda s: s["name"]).alias("r")).crossJoin(F.broadcast(ignore.agg(F.collect_list("name").alias("i"))))
    kept = params.required_without(F.col("r"), F.col("i"))
    return lists.select("grp", F.when(F.size(kept) > 0, F.array_join(kept, ",")).alias("required")).join(left, "grp", "left").select("grp", "required", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT o_orderkey, o_orderkey % 3 = 0 AS reused, CASE WHEN o_orderkey % 3 = 0 THEN 'out' || o_orderkey END AS output FROM orders")
def resume_by_content(spark, d):  # noqa: ANN001, ANN201
    inputs = load(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    before = inputs.where("o_orderkey % 3 = 0").select(dataflow.content_key("o_orderkey", "o_totalprice").alias("key"), F.concat(F.lit("out"), F.col("o_orderkey").cast("string")).alias("output"))
    todo, done = dataflow.resumed(inputs, before, "o_totalprice", "o_orderkey")
    return todo.select("o_orderkey", F.lit(False).alias("reused"), F.lit(None).cast("string").alias("output")).unionByName(done.select("o_orderkey", F.lit(True).alias("reused"), "output"))


@query("""SELECT c_custkey, 'S' || c_nationkey AS process, CASE WHEN c_nationkey % 4 = 0 THEN '--fast' ELSE '' END AS args, CASE WHEN c_nationkey % 3 = 0 THEN 'pre' || c_nationkey ELSE c_name END AS prefix
  FROM customer WHERE c_nationkey % 5 <> 2""")
def process_extensions(spark, d):  # noqa: ANN001, ANN201
    k = F.col("n_nationkey")
    process = F.concat(F.lit("S"), k.cast("string"))
    extensions = load(spark, d, "nation").where("n_nationkey % 7 <> 1 or n_nationkey % 5 = 2 or n_nationkey % 4 = 0 or n_nationkey % 3 = 0").select(process.alias("process"), F.when(k % 4 == 0, "--fast").alias("args"), F.when(k % 3 == 0, F.concat(F.lit("pre"), k.cast("string"))).otherwise("").alias("prefix"), F.when(k % 5 == 2, False).alias("enabled"))
    tasks = load(spark, d, "customer").select("c_custkey", F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("process"), F.col("c_name").alias("id"))
    return dataflow.with_extensions(tasks, extensions).select("c_custkey", "process", "args", "prefix")


@query("""SELECT 'calls' AS section, event_type AS sample, 'n' AS metric, count(*)::DOUBLE AS value FROM events GROUP BY event_type UNION ALL SELECT 'calls', event_type, 'last', max(event_id)::DOUBLE FROM events GROUP BY event_type
  UNION ALL SELECT 'orders', o_orderstatus, 'n', count(*)::DOUBLE FROM orders GROUP BY 2 UNION ALL SELECT 'orders', o_orderstatus, 'big', nullif(count(*) FILTER (o_totalprice > 400000), 0)::DOUBLE FROM orders GROUP BY 2 HAVING count(*) FILTER (o_totalprice > 400000) > 0""")
def report_assembled(spark, d):  # noqa: ANN001, ANN201
    calls = load(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last"))
    big = F.count_if(F.col("o_totalprice") > 400000)
    orders = load(spark, d, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.when(big > 0, big).alias("big"))
    return report.assembled(spark, {"calls": (calls, "event_type"), "orders": (orders, "o_orderstatus")})


@query("SELECT r_name AS process, n_name AS tool, n_nationkey::VARCHAR AS version FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 'Workflow', 'engine', '4.1' UNION ALL SELECT 'Workflow', 'flow', '1.0dev'")
def versions_workflow(spark, d):  # noqa: ANN001, ANN201
    return versions.with_workflow(_tools(spark, d), ("engine", "4.1"), ("flow", "1.0dev"))


def _tools(spark, d):  # noqa: ANN001, ANN202
    j = load(spark, d, "nation").join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.select(F.col("r_name").alias("process"), F.col("n_name").alias("tool"), F.col("n_nationkey").cast("string").alias("version"))


@query("""SELECT concat('id: ''software_versions''', chr(10), 'section_name: ''flow Software Versions''', chr(10), 'section_href: ''https://example.org/flow''', chr(10), 'plot_type: ''html''', chr(10), 'description: ''are collected at run time from the software output.''', chr(10), 'data: |', chr(10),
  '  <style>', chr(10), '  #v tbody:nth-child(even) {', chr(10), '      background-color: #f2f2f2;', chr(10), '  }', chr(10), '  </style>', chr(10), '  <table class="table" style="width:100%" id="v">', chr(10), '  <thead><tr><th> Process Name </th><th> Software </th><th> Version  </th></tr></thead>', chr(10), string_agg(b, chr(10) ORDER BY process), chr(10), '  </table>', chr(10)) AS text FROM (
  SELECT process, '  <tbody>' || chr(10) || string_agg('  <tr><td><samp>' || CASE WHEN r = 1 THEN process ELSE '' END || '</samp></td><td><samp>' || tool || '</samp></td><td><samp>' || version || '</samp></td></tr>', chr(10) ORDER BY r) || chr(10) || '  </tbody>' AS b
  FROM (SELECT r_name AS process, n_name AS tool, n_nationkey::VARCHAR AS version, row_number() OVER (PARTITION BY r_name ORDER BY n_name) AS r FROM nation JOIN region ON n_regionkey = r_regionkey) GROUP BY process)""")
def versions_section(spark, d):  # noqa: ANN001, ANN201
    return versions.section_document(versions.html(_tools(spark, d), "v"), "flow", "https://example.org/flow")


@query("SELECT process, name FROM (SELECT 'P' || p_size AS process, CASE p_partkey % 3 WHEN 0 THEN 'versions.yml' WHEN 1 THEN p_brand || '_versions.yml' ELSE 'x_versionsXyml' END AS name FROM part) WHERE name LIKE '%\\_versions.yml' ESCAPE '\\'")
def version_files_kept(spark, d):  # noqa: ANN001, ANN201
    k = F.col("p_partkey") % 3
    name = F.when(k == 0, "versions.yml").when(k == 1, F.concat("p_brand", F.lit("_versions.yml"))).otherwise("x_versionsXyml")
    return writers.version_files(load(spark, d, "part").select(F.concat(F.lit("P"), F.col("p_size").cast("string")).alias("process"), name.alias("name")))


@query("""SELECT o_orderkey AS task_id, md5(o_orderpriority || '|' || o_custkey)[1:2] || '/' || md5(o_orderpriority || '|' || o_custkey)[3:8] AS hash, o_orderpriority AS name, CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'FAILED' ELSE 'ABORTED' END AS status,
  CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 137 END AS exit, (o_orderkey % 60)::DOUBLE AS duration FROM orders""")
def run_trace(spark, d):  # noqa: ANN001, ANN201
    submit = F.col("o_orderdate").cast("timestamp")
    tasks = load(spark, d, "orders").select(F.col("o_orderkey").alias("task_id"), F.col("o_orderpriority").alias("name"), F.col("o_custkey").cast("string").alias("inputs"), F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 137).alias("exit"), submit.alias("submit"), (submit + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("o_orderkey") % 60)).alias("complete"))
    return report.trace(tasks).drop("submit")


@query("""SELECT user_id, n_failed, n_ignored, CASE WHEN user_id % 2 = 0 THEN '-[flow] Pipeline completed ' || CASE WHEN n_failed > 0 THEN 'with errors' WHEN n_ignored > 0 THEN 'successfully, but with errored process(es) ' ELSE 'successfully' END || '-'
  ELSE '-' || chr(27) || '[0;35m[flow]' || chr(27) || CASE WHEN n_failed > 0 THEN '[0;31m Pipeline completed with errors' WHEN n_ignored > 0 THEN '[0;33m Pipeline completed successfully, but with errored process(es) ' ELSE '[0;32m Pipeline completed successfully' END || chr(27) || '[0m-' END AS line
  FROM (SELECT user_id, count(*) FILTER (event_type = 'error') AS n_failed, count(*) FILTER (event_type = 'view') AS n_ignored FROM events GROUP BY user_id)""")
def log_summary(spark, d):  # noqa: ANN001, ANN201
    t = F.col("event_type")
    runs = load(spark, d, "events").groupBy("user_id").agg(F.count_if(t == "error").alias("n_failed"), F.count_if(t == "view").alias("n_ignored"))
    return report.log_summary(runs, "flow", F.col("user_id") % 2 == 0)


@query("""SELECT o_orderkey, o_orderkey || 'day 2dx' AS duration, strftime(o_orderdate, '%Y-%m-%d_%H-%M-%S') AS stamp, strftime(o_orderdate, '%b %-d, %Y, %-I:%M:%S %p') AS medium, 'a.b/' || o_orderpriority AS base,
  o_orderkey < 1000 AS fallback, o_orderkey <= 1000 AS template, CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN chr(27) || '[1;95m' WHEN 2 THEN chr(27) || '[4m' ELSE '' END AS colour FROM orders""")
def scalar_formats(spark, d):  # noqa: ANN001, ANN201
    k, at = F.col("o_orderkey"), F.col("o_orderdate").cast("timestamp")
    colour = F.when(k % 4 == 1, "bipurple").when(k % 4 == 2, "underlined").when(k % 4 == 3, "none").otherwise("red")
    return load(spark, d, "orders").select(
        k,
        S.day_unit(F.concat(k.cast("string"), F.lit("d 2dx"))).alias("duration"),
        S.file_stamp(at).alias("stamp"),
        S.medium_stamp(at).alias("medium"),
        S.base_name(F.concat(F.lit("a.b/"), "o_orderpriority", F.lit(".gz"))).alias("base"),
        S.attached(k, F.lit(1000)).alias("fallback"),
        S.attached(k, F.lit(1000), inclusive=True).alias("template"),
        S.colour(colour, k % 4 == 0).alias("colour"),
    )


@query("SELECT doc_id AS cell_id, coalesce(CASE WHEN doc_id % 2 = 0 THEN 'n' || doc_id END, 'g' || doc_id) AS geometry FROM documents WHERE doc_id % 5 <> 0")
def cell_features(spark, d):  # noqa: ANN001, ANN201
    k = F.col("doc_id")
    name = k.cast("string")
    features = load(spark, d, "documents").select(k.alias("cell_id"), F.when(k % 5 == 0, "annotation").otherwise("cell").alias("objectType"), F.when(k % 2 == 0, F.concat(F.lit("n"), name)).alias("nucleusGeometry"), F.concat(F.lit("g"), name).alias("geometry"))
    return spatial.segmented_features(features)


@query(f"SELECT transcript_id, cell_id AS cell, gene::VARCHAR AS gene, round(x, 6) AS x, round(y, 6) AS y, cell_id IS NULL AS is_noise FROM (SELECT p.*, n.cell_id FROM {_POINTS} p LEFT JOIN {_NEAREST} n USING (transcript_id))")
def prepared_transcripts(spark, d):  # noqa: ANN001, ANN201
    return spatial.prepared(assigned_of(spark, d)).withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})


@query("""SELECT n_nationkey AS cell_id, '{"type":"Feature","properties":{"cell":' || n_nationkey || '},"geometry":{"type":"Polygon","coordinates":[[[0,0],[' || n_nationkey || ',0],[0,' || n_regionkey || '],[0,0]]]}}' AS feature FROM nation""")
def cell_geojson(spark, d):  # noqa: ANN001, ANN201
    def point(x, y):  # noqa: ANN001, ANN202
        return F.struct(x.alias("x"), y.alias("y"))

    zero = F.lit(0)
    return spatial.geojson(load(spark, d, "nation").select(F.col("n_nationkey").alias("cell_id"), F.array(point(zero, zero), point(F.col("n_nationkey"), zero), point(zero, F.col("n_regionkey"))).alias("ring")))


@query(f"SELECT gene AS cell_id, nullif(count(*) FILTER (transcript_id % 4 = 0), 0)::DOUBLE AS \"0\", nullif(count(*) FILTER (transcript_id % 4 = 1), 0)::DOUBLE AS \"1\", nullif(count(*) FILTER (transcript_id % 4 = 2), 0)::DOUBLE AS \"2\" FROM {_POINTS} GROUP BY gene")
def cell_feature_matrix(spark, d):  # noqa: ANN001, ANN201
    p = points_of(spark, d).select(F.col("gene").alias("cell_id"), (F.col("transcript_id") % 4).alias("gene"))
    return spatial.wide(spatial.counts(p), [0, 1, 2])
