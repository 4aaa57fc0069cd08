"""A query for each operator over the test tables, and the DuckDB SQL that says the same.

The tables hold no sheets or transcripts, so each operator runs on a stand-in:
orders as sample sheets, parts as parameters, nations as a genome catalogue and
as software versions, embeddings as transcripts, events as tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions import scalars as S
from lattica.operators import catalogue, dataflow, params, report, sheet, spatial, versions
from lattica.plans.registry import query
from lattica.sinks import writers
from lattica.sources.readers import load

# --- sheets -----------------------------------------------------------------

_SHEET = """(SELECT o_orderkey AS line, 'cust ' || o_custkey AS sample, 'run_' || o_orderkey || '.fastq.gz' AS fastq_1,
    CASE WHEN o_orderstatus = 'F' THEN 'run_' || o_orderkey || '_2.fastq.gz' ELSE '' END AS fastq_2 FROM orders)"""
_BAD = """(SELECT line, CASE WHEN line % 97 = 5 THEN '' ELSE sample END AS sample, CASE WHEN line % 97 = 7 THEN 'run_' || line || '.txt' WHEN line % 97 = 11 THEN '' ELSE fastq_1 END AS fastq_1,
    CASE WHEN line % 97 = 9 AND fastq_2 <> '' THEN 'run_' || line || '.fq.gz' WHEN line % 97 = 13 AND fastq_2 <> '' THEN 'x.bam' ELSE fastq_2 END AS fastq_2 FROM """ + _SHEET + ")"
_ERROR = """CASE WHEN sample = '' THEN 'Sample input is required.' WHEN fastq_1 = '' THEN 'At least the first FASTQ file is required.'
    WHEN NOT (fastq_1 LIKE '%.fq.gz' OR fastq_1 LIKE '%.fastq.gz') THEN 'The FASTQ file has an unrecognized extension: ' || fastq_1
    WHEN fastq_2 <> '' AND NOT (fastq_2 LIKE '%.fq.gz' OR fastq_2 LIKE '%.fastq.gz') THEN 'The FASTQ file has an unrecognized extension: ' || fastq_2
    WHEN fastq_2 <> '' AND (fastq_1 LIKE '%.fq.gz') <> (fastq_2 LIKE '%.fq.gz') THEN 'FASTQ pairs must have the same file extensions.' END"""


def sheet_of(spark: SparkSession, d: str) -> DataFrame:
    """Orders as a sample sheet."""
    key = F.col("o_orderkey").cast("string")
    second = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("run_"), key, F.lit("_2.fastq.gz"))).otherwise("")
    return load(spark, d, "orders").select(F.col("o_orderkey").alias("line"), F.concat(F.lit("cust "), F.col("o_custkey").cast("string")).alias("sample"), F.concat(F.lit("run_"), key, F.lit(".fastq.gz")).alias("fastq_1"), second.alias("fastq_2"))


def bad_sheet_of(spark: SparkSession, d: str) -> DataFrame:
    """The same with rows of each kind of error."""
    m, key, paired = F.col("line") % 97, F.col("line").cast("string"), F.col("fastq_2") != ""
    return sheet_of(spark, d).select(
        "line",
        F.when(m == 5, "").otherwise(F.col("sample")).alias("sample"),
        F.when(m == 7, F.concat(F.lit("run_"), key, F.lit(".txt"))).when(m == 11, "").otherwise(F.col("fastq_1")).alias("fastq_1"),
        F.when((m == 9) & paired, F.concat(F.lit("run_"), key, F.lit(".fq.gz"))).when((m == 13) & paired, "x.bam").otherwise(F.col("fastq_2")).alias("fastq_2"),
    )


@query(f"SELECT line, replace(sample, ' ', '_') || '_T' || row_number() OVER (PARTITION BY sample ORDER BY line) AS sample, fastq_2 = '' AS single_end, fastq_1, fastq_2 FROM {_SHEET}")
def sheet_validated(spark, d):  # noqa: ANN001, ANN201
    return sheet.validated(sheet.require_columns(sheet_of(spark, d)))


@query(f"SELECT * FROM (SELECT line, {_ERROR} AS error FROM {_BAD}) WHERE error IS NOT NULL")
def sheet_errors(spark, d):  # noqa: ANN001, ANN201
    return sheet.errors(bad_sheet_of(spark, d))


@query(f"SELECT * FROM (SELECT line, {_ERROR} AS error FROM {_BAD}) WHERE error IS NOT NULL ORDER BY line LIMIT 1")
def sheet_errors_first(spark, d):  # noqa: ANN001, ANN201
    return sheet.first_error(bad_sheet_of(spark, d))


@query("SELECT 'cust_' || o_custkey AS sample, o_orderpriority || '.fq.gz' AS fastq_1, count(*) AS n FROM orders GROUP BY ALL HAVING count(*) > 1")
def sheet_duplicates(spark, d):  # noqa: ANN001, ANN201
    o = load(spark, d, "orders")
    return sheet.duplicates(sheet_of(spark, d).join(o.select(F.col("o_orderkey").alias("line"), "o_orderpriority"), "line").withColumn("fastq_1", F.concat("o_orderpriority", F.lit(".fq.gz"))))


@query(f"SELECT sample AS id, fastq_2 = '' AS single_end, fastq_1 AS first, nullif(fastq_2, '') AS second FROM {_SHEET}")
def sheet_reads_struct(spark, d):  # noqa: ANN001, ANN201
    rows = sheet_of(spark, d).withColumn("single_end", F.when(sheet.single_end(), "True").otherwise("False"))
    return sheet.reads(rows).select("meta.id", "meta.single_end", F.get("reads", F.lit(0)).alias("first"), F.get("reads", F.lit(1)).alias("second"))


@query("SELECT n_nationkey, n_nationkey % 2 = 0 AS complete FROM nation")
def sheet_required_cols(spark, d):  # noqa: ANN001, ANN201
    header = F.when(F.col("n_nationkey") % 2 == 0, F.array(*map(F.lit, (*sheet.REQUIRED, "extra")))).otherwise(F.array(F.lit("sample"), F.lit("fastq_1")))
    return load(spark, d, "nation").select("n_nationkey", dataflow.contains_all(header, sheet.REQUIRED).alias("complete"))


@query("SELECT DISTINCT 'doc_' || doc_id AS path FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_files_anti(spark, d):  # noqa: ANN001, ANN201
    path = F.concat(F.lit("doc_"), F.col("doc_id").cast("string"))
    return sheet.missing_files(load(spark, d, "documents").select(F.array(path).alias("reads")), load(spark, d, "labels").select(path.alias("path")))


# --- channels ---------------------------------------------------------------


@query("SELECT n_name AS item FROM nation UNION ALL SELECT r_name FROM region UNION ALL SELECT r_name FROM region")
def channel_mix(spark, d):  # noqa: ANN001, ANN201
    r = load(spark, d, "region").select(F.col("r_name").alias("item"))
    return dataflow.mix(load(spark, d, "nation").select(F.col("n_name").alias("item")), r, r)


@query("SELECT DISTINCT event_type, user_id FROM events")
def channel_unique(spark, d):  # noqa: ANN001, ANN201
    return dataflow.unique(load(spark, d, "events").select("event_type", "user_id"))


@query("SELECT event_id, event_type FROM events ORDER BY event_type, event_id LIMIT 1")
def channel_first(spark, d):  # noqa: ANN001, ANN201
    return dataflow.first(load(spark, d, "events").select("event_id", "event_type"), "event_type", "event_id")


@query("SELECT string_agg(r_name, ',' ORDER BY r_regionkey DESC) AS names, count(*) AS n FROM region")
def channel_collect(spark, d):  # noqa: ANN001, ANN201
    out = dataflow.collected(load(spark, d, "region").withColumn("k", -F.col("r_regionkey")), "r_name", "k")
    return out.select(F.array_join("items", ",").alias("names"), F.size("items").cast("long").alias("n"))


@query("SELECT 0::BIGINT AS n, '' AS names")
def channel_collect_empty(spark, d):  # noqa: ANN001, ANN201
    out = dataflow.collected(dataflow.empty(spark, "k int, name string"), "name", "k")
    return out.select(F.size("items").cast("long").alias("n"), F.array_join("items", ",").alias("names"))


@query("SELECT n_name, r_name, 'x' AS tag FROM nation CROSS JOIN region")
def channel_combine(spark, d):  # noqa: ANN001, ANN201
    pairs = dataflow.combine(load(spark, d, "nation").select("n_name"), load(spark, d, "region").select("r_name"))
    return dataflow.combine(pairs, dataflow.value(spark, ("x",), "tag string"))


@query("SELECT o_orderkey AS id, o_orderstatus, sum(l_quantity) AS quantity FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL")
def channel_by_key(spark, d):  # noqa: ANN001, ANN201
    items = load(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.sum("l_quantity").alias("quantity"))
    return dataflow.joined_by_key("id", load(spark, d, "orders").select(F.col("o_orderkey").alias("id"), "o_orderstatus"), items)


@query("SELECT event_id FROM events WHERE coalesce(CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id % 3 = 1 END, true)")
def channel_when(spark, d):  # noqa: ANN001, ANN201
    u = F.col("user_id") % 3
    return dataflow.when(load(spark, d, "events"), F.when(u != 0, u == 1)).select("event_id")


@query("SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier")
def list_intersect(spark, d):  # noqa: ANN001, ANN201
    return dataflow.intersect(load(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")), load(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))


@query("SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def list_difference(spark, d):  # noqa: ANN001, ANN201
    return dataflow.difference(load(spark, d, "customer").select(F.col("c_nationkey").alias("k")), load(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("k")))


# --- catalogue --------------------------------------------------------------

_CUSTOMERS = "(SELECT c_custkey, CASE WHEN c_custkey % 10 = 3 THEN '' ELSE n_name END AS genome FROM customer JOIN nation ON c_nationkey = n_nationkey)"


def catalogue_of(spark: SparkSession, d: str) -> DataFrame:
    """Nations but the last five, with two attributes."""
    n = load(spark, d, "nation").where("n_nationkey < 20")
    return n.select(F.col("n_name").alias("key"), F.explode(F.create_map(F.lit("region"), F.col("n_regionkey").cast("string"), F.lit("size"), F.col("n_nationkey").cast("string"))).alias("attr", "value"))


def genomes_of(spark: SparkSession, d: str) -> DataFrame:
    c = load(spark, d, "customer").join(load(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select("c_custkey", F.when(F.col("c_custkey") % 10 == 3, "").otherwise(F.col("n_name")).alias("genome"))


@query(f"SELECT c_custkey, genome, n_regionkey::VARCHAR AS fasta FROM {_CUSTOMERS} LEFT JOIN nation ON genome = n_name AND n_nationkey < 20")
def genome_lookup(spark, d):  # noqa: ANN001, ANN201
    return catalogue.lookup(genomes_of(spark, d), catalogue_of(spark, d), "genome", "region", "fasta")


@query(f"SELECT c_custkey, genome FROM {_CUSTOMERS} WHERE genome <> '' AND genome NOT IN (SELECT n_name FROM nation WHERE n_nationkey < 20)")
def genome_missing(spark, d):  # noqa: ANN001, ANN201
    return catalogue.unknown(genomes_of(spark, d), catalogue_of(spark, d), "genome").select("c_custkey", "genome")


# --- parameters -------------------------------------------------------------

_PARAMS = "(SELECT p_partkey AS pos, CASE WHEN p_partkey % 2 = 0 THEN 'Opt-' || (p_partkey % 50) ELSE 'opt' || (p_partkey % 70) END AS name FROM part)"


@query(f"""WITH p AS {_PARAMS}, e AS (SELECT 'opt' || p_partkey AS name FROM part WHERE p_partkey <= 30),
  rest AS (SELECT pos, name, lower(replace(name, '-', '')) AS n FROM p WHERE name NOT IN (SELECT name FROM e) AND name NOT IN ('opt60', 'opt61')
    AND NOT (name LIKE '%-%' AND lower(replace(name, '-', '')) IN (SELECT name FROM e)))
  SELECT name FROM (SELECT name, row_number() OVER (PARTITION BY n ORDER BY pos) AS r FROM rest) WHERE r = 1""")
def params_unexpected(spark, d):  # noqa: ANN001, ANN201
    p, k = load(spark, d, "part"), F.col("p_partkey")
    name = F.when(k % 2 == 0, F.concat(F.lit("Opt-"), (k % 50).cast("string"))).otherwise(F.concat(F.lit("opt"), (k % 70).cast("string")))
    schema = p.where(k <= 30).select(F.concat(F.lit("opt"), k.cast("string")).alias("name"))
    ignore = dataflow.of(spark, [("opt60",), ("opt61",)], "name string")
    return params.unexpected(p.select(k.alias("pos"), name.alias("name")), schema, ignore, "pos")


@query("SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'resume' WHEN 1 THEN 'work-dir' ELSE 'input' END AS name FROM part WHERE p_partkey % 5 < 2")
def params_reserved_semi(spark, d):  # noqa: ANN001, ANN201
    k = F.col("p_partkey")
    return params.reserved(load(spark, d, "part").select(k, F.when(k % 5 == 0, "resume").when(k % 5 == 1, "work-dir").otherwise("input").alias("name")))


@query("""WITH j AS (SELECT p_brand AS grp, 'p' || p_partkey AS name, CASE WHEN p_partkey % 11 = 0 THEN 'out/' || p_size WHEN p_partkey % 13 = 0 THEN '' WHEN p_partkey % 7 = 0 THEN '/home/data/' || p_size ELSE p_size::VARCHAR END AS value,
    CASE WHEN p_partkey % 11 = 0 THEN '$params.outdir/' || (p_partkey % 50) WHEN p_partkey % 13 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN '${projectDir}/data/' || (p_partkey % 4) WHEN p_partkey % 3 = 0 THEN NULL ELSE (p_partkey % 50)::VARCHAR END AS d FROM part)
  SELECT grp, name, value FROM j WHERE (CASE WHEN d IS NOT NULL THEN value <> d ELSE value NOT IN ('', 'false') END)
    AND NOT coalesce(d LIKE '$params.outdir%' AND 'out' || replace(d, '$params.outdir', '') = value, false)
    AND NOT coalesce(d LIKE '${projectDir}%' AND contains(value, replace(d, '${projectDir}', '')), false)""")
def params_diff_default(spark, d):  # noqa: ANN001, ANN201
    k, size = F.col("p_partkey"), F.col("p_size").cast("string")
    name = F.concat(F.lit("p"), k.cast("string"))
    value = F.when(k % 11 == 0, F.concat(F.lit("out/"), size)).when(k % 13 == 0, "").when(k % 7 == 0, F.concat(F.lit("/home/data/"), size)).otherwise(size)
    default = F.when(k % 11 == 0, F.concat(F.lit("$params.outdir/"), (k % 50).cast("string"))).when(k % 13 == 0, F.lit(None)).when(k % 7 == 0, F.concat(F.lit("${projectDir}/data/"), (k % 4).cast("string"))).when(k % 3 == 0, F.lit(None)).otherwise((k % 50).cast("string"))
    p = load(spark, d, "part")
    return params.summary(p.select(name.alias("name"), value.alias("value")), p.select(F.col("p_brand").alias("grp"), name.alias("name"), F.lit("string").alias("type"), default.alias("default")), F.lit("out"))


@query("SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1")
def params_overlay(spark, d):  # noqa: ANN001, ANN201
    return dataflow.overlay(load(spark, d, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice"), "o_custkey", "o_orderdate", "o_orderkey")


@query("""WITH j AS (SELECT 'e' || event_id AS name, event_id % 4 AS m, CASE WHEN event_id % 40 = 5 THEN NULL ELSE event_type END AS v, user_id FROM events)
  SELECT * FROM (SELECT name, CASE
    WHEN v IS NULL THEN '* Missing required parameter: --' || name
    WHEN m = 1 THEN '* --' || name || ': expected type: integer (' || v || ')'
    WHEN m = 2 AND v NOT IN ('click', 'view') THEN '* --' || name || ': ''' || v || ''' is not a valid choice (Available choices: click, view)'
    WHEN m = 3 AND v NOT IN ('click', 'a', 'b', 'c', 'd', 'e') THEN '* --' || name || ': ''' || v || ''' is not a valid choice (Available choices (5 of 6): click, a, b, c, d, ... )'
    WHEN m = 0 AND NOT regexp_matches(v, '^[cv].*$') THEN '* --' || name || ': does not match pattern ^[cv].*$ (' || v || ')' END AS error FROM j) WHERE error IS NOT NULL""")
def params_enum_pattern_type(spark, d):  # noqa: ANN001, ANN201
    e, m = load(spark, d, "events"), F.col("event_id") % 4
    name = F.concat(F.lit("e"), F.col("event_id").cast("string"))
    enum = F.when(m == 2, F.array(F.lit("click"), F.lit("view"))).when(m == 3, F.array(*map(F.lit, ("click", "a", "b", "c", "d", "e")))).otherwise(F.array().cast("array<string>"))
    schema = e.select(name.alias("name"), F.when(m == 1, "integer").otherwise("string").alias("type"), enum.alias("enum"), F.when(m == 0, "^[cv].*$").alias("pattern"), F.lit(True).alias("required"))
    return params.violations(e.where("event_id % 40 <> 5").select(name.alias("name"), F.col("event_type").alias("value")), schema)


@query("""SELECT l_orderkey, l_linenumber, CASE l_linenumber % 3 WHEN 0 THEN l_linenumber || 'day' WHEN 1 THEN (l_discount * 100)::INT::VARCHAR ELSE 'true' END AS value
  FROM lineitem WHERE CASE l_linenumber % 3 WHEN 0 THEN true WHEN 1 THEN (l_discount * 100)::INT <> 0 ELSE l_returnflag = 'A' END""")
def params_clean(spark, d):  # noqa: ANN001, ANN201
    n = F.col("l_linenumber")
    kind = F.when(n % 3 == 0, "duration").when(n % 3 == 1, "number").otherwise("boolean")
    value = F.when(n % 3 == 0, F.concat(n.cast("string"), F.lit("d"))).when(n % 3 == 1, F.round(F.col("l_discount") * 100).cast("int").cast("string")).otherwise(F.when(F.col("l_returnflag") == "A", "true").otherwise("false"))
    return params.cleaned(load(spark, d, "lineitem").select("l_orderkey", "l_linenumber", kind.alias("type"), value.alias("value"))).select("l_orderkey", "l_linenumber", "value")


_WRAP = "list_reduce(string_split({t}, ' '), lambda acc, w: CASE WHEN length(string_split(acc, chr(10))[-1]) + length(w) <= {n} THEN acc || w || ' ' ELSE acc || chr(10) || w || ' ' END, '')"


@query(f"SELECT item_id, CASE WHEN length(text) <= 60 THEN text ELSE {_WRAP.format(t='text', n=60)} END AS text FROM (SELECT doc_id AS item_id, replace(left(text, 2000), chr(10), ' ') AS text FROM documents)")
def text_wrap(spark, d):  # noqa: ANN001, ANN201
    # a description is short: the start of each text stands for one
    return load(spark, d, "documents").select(F.col("doc_id").alias("item_id"), F.array_join(S.wrapped(F.replace(F.left("text", F.lit(2000)), F.lit("\n"), F.lit(" ")), 60), "\n").alias("text"))


_HELP = "p_name || ' ' || p_type || ' [default: ' || p_size || ']'"


@query(f"""SELECT p_brand AS grp, 'p' || p_partkey AS name, '  --' || rpad('p' || p_partkey, (SELECT max(length('p' || p_partkey)) FROM part)::INT, ' ') || rpad(CASE WHEN p_size % 2 = 0 THEN '[integer]' ELSE '[string]' END, 10, ' ')
  || CASE WHEN length({_HELP}) <= 24 THEN {_HELP} ELSE {_WRAP.format(t=_HELP, n=24)} END AS text FROM part WHERE p_size <= 40""")
def params_help_wrap(spark, d):  # noqa: ANN001, ANN201
    size = F.col("p_size")
    schema = load(spark, d, "part").select(F.col("p_brand").alias("grp"), F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("name"), F.when(size % 2 == 0, "integer").otherwise("string").alias("type"), F.concat("p_name", F.lit(" "), "p_type").alias("title"), size.cast("string").alias("default"), (size > 40).alias("hidden"))
    return params.help_lines(schema, 24)


@query("SELECT p_brand AS grp, count(*) FILTER (p_size <= 25) AS shown, count(*) FILTER (p_size > 25) AS hidden FROM part GROUP BY 1 HAVING count(*) FILTER (p_size <= 25) > 0")
def params_group_counts(spark, d):  # noqa: ANN001, ANN201
    return params.counts_by_group(load(spark, d, "part").select(F.col("p_brand").alias("grp"), (F.col("p_size") > 25).alias("hidden")))


@query("""SELECT conv_id, CASE WHEN NOT list_contains(r, 'user') OR NOT list_contains(r, 'assistant') THEN true ELSE NOT (list_position(r, 'user') < list_position(r, 'assistant')) END AS bad
  FROM (SELECT conv_id, list(role ORDER BY turn, role) AS r FROM conversations GROUP BY conv_id)""")
def conda_channel_order(spark, d):  # noqa: ANN001, ANN201
    # conversations are short by nature: their roles stand for a channel list
    roles = load(spark, d, "conversations").groupBy("conv_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", "role"))), lambda s: s["role"]).alias("r"))
    return roles.select("conv_id", params.channels_violate(F.col("r"), ("user", "assistant")).alias("bad"))


@query("""WITH RECURSIVE e AS (SELECT n_nationkey AS id, CASE WHEN n_nationkey < 2 THEN NULL ELSE n_nationkey // 2 END AS parent, n_name AS message FROM nation),
  walk AS (SELECT id, 0 AS depth, message FROM e WHERE parent IS NULL UNION ALL SELECT e.id, depth + 1, e.message FROM e JOIN walk ON e.parent = walk.id)
  SELECT id, depth, message FROM walk WHERE id NOT IN (SELECT parent FROM e WHERE parent IS NOT NULL)""")
def nested_errors(spark, d):  # noqa: ANN001, ANN201
    k = F.col("n_nationkey")
    return params.leaf_errors(load(spark, d, "nation").select(k.alias("id"), F.when(k >= 2, F.floor(k / 2).cast("int")).alias("parent"), F.col("n_name").alias("message")))


# --- versions and reports ---------------------------------------------------

_VERSIONS = "(SELECT 'flow:' || c_mktsegment || ':' || upper(n_name) AS process, 'tool' || (c_custkey % 3) AS tool, (CASE WHEN n_nationkey % 5 = 0 THEN length(c_mktsegment) ELSE 0 END) || '.' || (c_custkey % 3) AS version FROM customer JOIN nation ON c_nationkey = n_nationkey)"


def versions_of(spark: SparkSession, d: str) -> DataFrame:
    """A version table from customers and nations; every fifth nation's modules disagree."""
    c = load(spark, d, "customer").join(load(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k = (F.col("c_custkey") % 3).cast("string")
    major = F.when(F.col("n_nationkey") % 5 == 0, F.length("c_mktsegment")).otherwise(0).cast("string")
    return c.select(F.concat(F.lit("flow:"), "c_mktsegment", F.lit(":"), F.upper("n_name")).alias("process"), F.concat(F.lit("tool"), k).alias("tool"), F.concat(major, F.lit("."), k).alias("version"))


@query(f"""SELECT module, count(DISTINCT v) AS variants FROM (SELECT process, split_part(process, ':', -1) AS module, string_agg(DISTINCT tool || '=' || version, ',' ORDER BY tool || '=' || version) AS v FROM {_VERSIONS} GROUP BY process)
  GROUP BY module HAVING count(DISTINCT v) > 1""")
def versions_consistency(spark, d):  # noqa: ANN001, ANN201
    return versions.inconsistent(versions_of(spark, d))


@query(f"""SELECT process, tool, version, CASE WHEN row_number() OVER (PARTITION BY process ORDER BY tool, version) = 1 THEN process ELSE '' END AS label
  FROM (SELECT DISTINCT split_part(process, ':', -1) AS process, tool, version FROM {_VERSIONS})""")
def versions_table(spark, d):  # noqa: ANN001, ANN201
    own = versions_of(spark, d).select(S.last_segment(F.col("process")).alias("process"), "tool", "version").distinct()
    return versions.labelled(own)


@query("""SELECT concat('<table class="table" style="width:100%">', chr(10), '<thead><tr><th> Process Name </th><th> Software </th><th> Version  </th></tr></thead>', chr(10), string_agg(b, chr(10) ORDER BY process), chr(10), '</table>') AS html FROM (
  SELECT process, '<tbody>' || chr(10) || string_agg('<tr><td><samp>' || CASE WHEN r = 1 THEN process ELSE '' END || '</samp></td><td><samp>' || tool || '</samp></td><td><samp>' || version || '</samp></td></tr>', chr(10) ORDER BY r) || chr(10) || '</tbody>' AS b
  FROM (SELECT r_name AS process, n_name AS tool, n_nationkey::VARCHAR AS version, row_number() OVER (PARTITION BY r_name ORDER BY n_name) AS r FROM nation JOIN region ON n_regionkey = r_regionkey) GROUP BY process)""")
def versions_html(spark, d):  # noqa: ANN001, ANN201
    j = load(spark, d, "nation").join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return versions.html(j.select(F.col("r_name").alias("process"), F.col("n_name").alias("tool"), F.col("n_nationkey").cast("string").alias("version")))


@query("SELECT r_name AS process, r_name || ':' || chr(10) || string_agg('  ' || n_name || ': ''' || n_nationkey || '''', chr(10) ORDER BY n_name) AS text FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name")
def versions_document(spark, d):  # noqa: ANN001, ANN201
    j = load(spark, d, "nation").join(load(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return writers.version_document(j.select(F.col("r_name").alias("process"), F.col("n_name").alias("tool"), F.col("n_nationkey").cast("string").alias("version")))


@query("SELECT user_id % 50 AS batch, count(*) FILTER (event_type NOT IN ('error', 'view')) AS n_ok, count(*) FILTER (event_type = 'view') AS n_ignored, count(*) FILTER (event_type = 'error') AS n_failed, CASE WHEN count(*) FILTER (event_type = 'error') > 0 THEN 'failed' WHEN count(*) FILTER (event_type = 'view') > 0 THEN 'completed with errors' ELSE 'success' END AS status FROM events GROUP BY 1")
def run_summary(spark, d):  # noqa: ANN001, ANN201
    t = F.col("event_type")
    return report.run_summary(load(spark, d, "events").select((F.col("user_id") % 50).alias("batch"), (~t.isin("error", "view")).alias("ok"), (t == "view").alias("ignored")), "batch")


@query("SELECT p_brand AS grp, string_agg('<dt>' || p_partkey || '</dt><dd><samp>' || CASE WHEN p_size % 4 = 0 THEN 'N/A' ELSE p_type END || '</samp></dd>', chr(10) ORDER BY p_size DESC, p_partkey) AS html FROM part GROUP BY p_brand")
def report_sections(spark, d):  # noqa: ANN001, ANN201
    p = load(spark, d, "part").select(F.col("p_brand").alias("grp"), F.col("p_size").alias("weight"), F.col("p_partkey").alias("item"), F.when(F.col("p_size") % 4 == 0, "").otherwise(F.col("p_type")).alias("value"))
    return report.sections(p, "weight", "grp", "item").select("grp", "html")


# --- resources and routing --------------------------------------------------

@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN least(l_linenumber * 6442450944, 21474836480) ELSE l_linenumber * 6442450944 END AS memory, least(l_linenumber * 14400, 43200) AS time, least(l_linenumber * 2, 6) AS cpus,
  CASE WHEN l_quantity::INT + 100 IN (143, 137, 104, 134, 139) THEN 'retry' ELSE 'finish' END AS strategy FROM lineitem""")
def resource_cap(spark, d):  # noqa: ANN001, ANN201
    t = load(spark, d, "lineitem").withColumn("attempt", F.col("l_linenumber").cast("long"))
    cap = S.amount(F.when(F.col("l_linenumber") % 2 == 0, "20.GB").otherwise("plenty"), "memory")
    out = report.requests(t, {"memory": 6 * 1024**3, "time": 4 * 3600, "cpus": 2}, {"memory": cap, "time": S.amount(F.lit("12.h"), "time"), "cpus": F.lit(6)})
    return out.select("l_orderkey", "l_linenumber", F.col("memory").cast("long").alias("memory"), F.col("time").cast("long").alias("time"), F.col("cpus").cast("long").alias("cpus"), S.on_exit(F.col("l_quantity").cast("int") + 100).alias("strategy"))


@query("SELECT 'flow:sub:' || upper(replace(p_type, ' ', '_')) AS process, p_name || '.txt' AS name, lower(split_part(p_type, ' ', 1)) AS folder FROM part WHERE p_partkey % 3 <> 0")
def publish_path(spark, d):  # noqa: ANN001, ANN201
    name = F.when(F.col("p_partkey") % 3 == 0, "versions.yml").otherwise(F.concat("p_name", F.lit(".txt")))
    return writers.routed(load(spark, d, "part").select(F.concat(F.lit("flow:sub:"), F.upper(F.replace("p_type", F.lit(" "), F.lit("_")))).alias("process"), name.alias("name")))


@query("SELECT event_id, 'run --input x' || CASE WHEN event_id % 2 = 0 THEN '' ELSE ' --b' END AS command, CASE WHEN event_type = 'click' THEN '_hidden_' ELSE props END AS shown FROM events")
def webhook_redact(spark, d):  # noqa: ANN001, ANN201
    e = load(spark, d, "events")
    command = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("run --input x --hook_url http://h/"), F.col("event_id").cast("string"))).otherwise("run --input x  --hook_url http://h/a --b")
    return e.select("event_id", S.without_hook(command).alias("command"), S.redact(F.when(F.col("event_type") == "click", "hook_url").otherwise("other"), F.col("props")).alias("shown"))


@query("""SELECT p_partkey, CASE WHEN p_size > 0 AND p_size % 10 <> 0 THEN '--expansion=' || p_size % 10 ELSE '' END AS flag, CASE WHEN p_size % 3 = 0 THEN 'none' ELSE p_brand END AS brand, CASE WHEN p_size % 2 = 0 THEN 'microns' ELSE 'pixels' END AS units,
  'v' || p_size || '.0' || CASE WHEN p_size % 2 = 0 THEN '-g0123456' ELSE '' END AS version, regexp_extract('a.' || p_name || '.tar.gz', '((?:[.][^./]+){0,2})$', 1) AS suffixes, rpad(p_brand, greatest(length(p_brand), 12)::INT, ' ') AS padded FROM part""")
def scalar_functions(spark, d):  # noqa: ANN001, ANN201
    size = F.col("p_size")
    return load(spark, d, "part").select(
        "p_partkey",
        S.flag("expansion", size % 10, "integer").alias("flag"),
        S.or_else(F.when(size % 3 == 0, "").otherwise(F.col("p_brand")), F.lit("none")).alias("brand"),
        S.units_of(F.when(size % 2 == 0, "m.csv")).alias("units"),
        S.version_string(F.concat(F.when(size % 5 == 0, "v").otherwise(""), size.cast("string"), F.lit(".0")), F.when(size % 2 == 0, "0123456789ab")).alias("version"),
        S.suffixes(F.concat(F.lit("a."), "p_name", F.lit(".tar.gz"))).alias("suffixes"),
        S.pad_right(F.col("p_brand"), F.lit(12)).alias("padded"),
    )


@query("SELECT item_id, 'Item ' || item_id || ': ' || replace(text, ' ', '_') || '.' AS filled, regexp_replace(to_base64(encode(text)), '(.{76})', '\\1' || chr(10), 'g') AS coded FROM benchmark")
def templates_and_base64(spark, d):  # noqa: ANN001, ANN201
    filled = S.substituted(F.lit("Item ${id}: ${text}."), {"id": F.col("item_id").cast("string"), "text": F.replace("text", F.lit(" "), F.lit("_"))})
    coded = S.chunked_base64(F.encode("text", "UTF-8"))
    return load(spark, d, "benchmark").select("item_id", filled.alias("filled"), F.when(F.length(F.replace(coded, F.lit("\n"), F.lit(""))) % 76 == 0, F.concat(coded, F.lit("\n"))).otherwise(coded).alias("coded"))


# --- spatial contracts ------------------------------------------------------

_POINTS = "(SELECT vec_id AS transcript_id, label AS gene, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings)"
_CELLS = f"(SELECT gene AS cell_id, round(avg(x), 6) AS x, round(avg(y), 6) AS y FROM {_POINTS} GROUP BY gene)"
_NEAREST = f"(SELECT * FROM (SELECT p.transcript_id, p.gene, p.x, p.y, c.cell_id, sqrt((p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y)) AS dist, row_number() OVER (PARTITION BY p.transcript_id ORDER BY sqrt((p.x - c.x) * (p.x - c.x) + (p.y - c.y) * (p.y - c.y)), c.cell_id) AS r FROM {_POINTS} p, {_CELLS} c) WHERE r = 1 AND dist <= 0.1)"


def points_of(spark: SparkSession, d: str) -> DataFrame:
    """Embeddings as transcripts at their first two components."""
    return load(spark, d, "embeddings").select(F.col("vec_id").alias("transcript_id"), F.col("label").alias("gene"), F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"))


def cells_of(spark: SparkSession, d: str) -> DataFrame:
    return points_of(spark, d).groupBy(F.col("gene").alias("cell_id")).agg(F.round(F.avg("x"), 6).alias("x"), F.round(F.avg("y"), 6).alias("y"))


def assigned_of(spark: SparkSession, d: str) -> DataFrame:
    p = points_of(spark, d)
    return spatial.assign_by_table(p, spatial.nearest_cell(p, cells_of(spark, d), 0.1))


@query(f"SELECT transcript_id, gene, x, y, coalesce(n_name, gene::VARCHAR) AS label FROM {_POINTS} LEFT JOIN nation ON gene = n_nationkey AND n_nationkey % 2 = 0")
def relabel(spark, d):  # noqa: ANN001, ANN201
    panel = load(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("gene"), F.col("n_name").alias("label"))
    return spatial.relabel(points_of(spark, d), panel).select("transcript_id", "gene", "x", "y", "label")


@query(f"SELECT transcript_id, gene, quality AS cell_id FROM {_POINTS} LEFT JOIN labels ON transcript_id = doc_id")
def assign_by_table(spark, d):  # noqa: ANN001, ANN201
    return spatial.assign_by_table(points_of(spark, d), load(spark, d, "labels").select(F.col("doc_id").alias("transcript_id"), F.col("quality").alias("cell_id"))).select("transcript_id", "gene", "cell_id")


@query(f"SELECT transcript_id, cell_id FROM {_POINTS} p JOIN {_CELLS} c ON p.x >= c.x - 0.05 AND p.x < c.x + 0.05 AND p.y >= c.y - 0.08 AND p.y < c.y + 0.08")
def assign_box(spark, d):  # noqa: ANN001, ANN201
    boxes = cells_of(spark, d).select("cell_id", (F.col("x") - 0.05).alias("x0"), (F.col("y") - 0.08).alias("y0"), (F.col("x") + 0.05).alias("x1"), (F.col("y") + 0.08).alias("y1"))
    return spatial.in_boxes(points_of(spark, d), boxes, 0.05)


@query(f"SELECT transcript_id, cell_id FROM {_POINTS} p JOIN {_CELLS} c ON abs(p.x - c.x) + abs(p.y - c.y) < 0.07")
def assign_polygon(spark, d):  # noqa: ANN001, ANN201
    def corner(dx: float, dy: float):  # noqa: ANN202
        return F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))

    diamonds = cells_of(spark, d).select("cell_id", F.array(corner(0.07, 0), corner(0, 0.07), corner(-0.07, 0), corner(0, -0.07)).alias("ring"))
    return spatial.in_polygons(points_of(spark, d), diamonds, 0.07)


@query(f"SELECT transcript_id, cell_id, round(dist, 6) AS dist FROM {_NEAREST}")
def nearest_cell(spark, d):  # noqa: ANN001, ANN201
    return spatial.nearest_cell(points_of(spark, d), cells_of(spark, d), 0.1).withColumn("dist", F.round("dist", 6))


@query(f"SELECT transcript_id, round(x * 2 + y * 0.5 + 1, 6) AS x, round(x * -0.5 + y * 2 - 1, 6) AS y FROM {_POINTS}")
def affine(spark, d):  # noqa: ANN001, ANN201
    return spatial.affine(points_of(spark, d), ((2, 0.5, 1), (-0.5, 2, -1))).select("transcript_id", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"))


@query(f"SELECT cell_id, gene, count(*)::DOUBLE AS value FROM {_NEAREST} GROUP BY ALL")
def cell_gene_counts(spark, d):  # noqa: ANN001, ANN201
    return spatial.counts(assigned_of(spark, d))


@query(f"SELECT cell_id, round(avg(x), 6) AS cx, round(avg(y), 6) AS cy, count(*) AS n FROM {_NEAREST} GROUP BY cell_id")
def cell_meta(spark, d):  # noqa: ANN001, ANN201
    return spatial.cell_metadata(assigned_of(spark, d)).withColumns({"cx": F.round("cx", 6), "cy": F.round("cy", 6)})


@query(f"SELECT p.gene, count(*) AS n, count(n.cell_id) AS n_assigned FROM {_POINTS} p LEFT JOIN {_NEAREST} n USING (transcript_id) GROUP BY p.gene")
def gene_meta(spark, d):  # noqa: ANN001, ANN201
    return spatial.gene_metadata(assigned_of(spark, d))


@query(f"SELECT cell_id, gene, round(count(*) / 0.25, 6) AS rate FROM {_NEAREST} GROUP BY ALL")
def cell_gene_rates(spark, d):  # noqa: ANN001, ANN201
    exposure = cells_of(spark, d).select("cell_id", F.lit(0.25).alias("volume"))
    return spatial.rates(spatial.counts(assigned_of(spark, d)), exposure).withColumn("rate", F.round("rate", 6))


_EDGES = """SELECT a.cell_id, a.z, a.x, a.y FROM p a WHERE EXISTS (SELECT 1 FROM p b WHERE b.cell_id = a.cell_id AND b.z = a.z AND (b.x <> a.x OR b.y <> a.y)
  AND NOT EXISTS (SELECT 1 FROM p c WHERE c.cell_id = a.cell_id AND c.z = a.z AND (b.x - a.x) * (c.y - a.y) - (b.y - a.y) * (c.x - a.x) < 0))"""


@query(f"WITH p AS (SELECT DISTINCT gene AS cell_id, 0 AS z, x, y FROM {_POINTS}) SELECT cell_id, x, y FROM ({_EDGES})")
def cell_hull(spark, d):  # noqa: ANN001, ANN201
    rings = spatial.hulls(points_of(spark, d).withColumnRenamed("gene", "cell_id"))
    return rings.select("cell_id", F.explode("ring").alias("p")).select("cell_id", "p.x", "p.y")


@query(f"WITH p AS (SELECT DISTINCT gene AS cell_id, (transcript_id % 3)::INT AS z, x, y FROM {_POINTS}) {_EDGES}")
def cell_layer_hulls(spark, d):  # noqa: ANN001, ANN201
    rings = spatial.hulls(points_of(spark, d).withColumnRenamed("gene", "cell_id").withColumn("z", (F.col("transcript_id") % 3).cast("int")), "cell_id", "z")
    return rings.select("cell_id", "z", F.explode("ring").alias("p")).select("cell_id", "z", "p.x", "p.y")


@query("""SELECT p_partkey, CASE WHEN p_size % 4 = 0 AND p_size % 3 = 0 THEN 'transcript_assignment excludes nuclei and cells' WHEN p_size % 4 = 0 AND p_size % 5 <> 0 THEN 'transcript_assignment needs viz_polygons'
  WHEN p_size * 3 > 100 THEN 'expansion_distance must be 0 to 100' WHEN p_size - 3 < 0 THEN 'dapi_filter must not be negative' END AS problem FROM part""")
def import_options(spark, d):  # noqa: ANN001, ANN201
    size = F.col("p_size")
    p = load(spark, d, "part").select("p_partkey", F.when(size % 4 == 0, "a.csv").alias("transcript_assignment"), F.when(size % 5 == 0, "p.geojson").alias("viz_polygons"), F.when(size % 3 == 0, "n.npy").alias("nuclei"), F.lit("").alias("cells"), (size * 3).alias("expansion_distance"), (size - 3).alias("dapi_filter"))
    return spatial.import_options(p).select("p_partkey", "problem")
