"""Sources: delimited sheets, parameter schemas, version documents, catalogues, bundles, archives.

All go through Spark's readers, so paths may be in any store that Spark opens.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the Parquet tables of an input folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sniffed(spark: SparkSession, path: str, lines: int = 10) -> csv.Dialect:
    """The dialect of a sheet, from its first lines; an error if they show no header."""
    peek = "\n".join(r.value for r in spark.read.text(path).limit(lines).collect()) + "\n"
    if not csv.Sniffer().has_header(peek):
        raise ValueError("no header found in the first lines of the sheet")
    return csv.Sniffer().sniff(peek)


def sheet(spark: SparkSession, path: str, sep: str | None = None) -> DataFrame:
    """A sheet as text columns and `line`, its rows' ordinal from 0 without blank lines.

    Empty fields are empty strings. A row with fewer or more fields than the header
    fails. A sheet is one file, read in one task, as the order of its rows counts;
    fields don't span lines.
    """
    sep = sep or sniffed(spark, path).delimiter
    whole = spark.read.text(path, wholetext=True)
    rows = whole.select(F.explode(F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")).alias("value"))
    header = next(csv.reader([rows.first().value], delimiter=sep))
    ordered = whole.select(F.posexplode(F.filter(F.split("value", r"\r?\n"), lambda x: F.trim(x) != "")).alias("line", "value")).where("line > 0")

    def parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fields = list(csv.reader(b["value"].tolist(), delimiter=sep))
            bad = [n for n, f in zip(b["line"], fields) if len(f) != len(header)]
            if bad:
                raise ValueError(f"line {bad[0] + 1} has another number of fields than the header")
            yield pd.DataFrame({"line": b["line"] - 1, **{h: [f[i] for f in fields] for i, h in enumerate(header)}})

    schema = StructType([StructField("line", ordered.select(F.col("line").cast("long")).schema[0].dataType), *[StructField(h, StringType()) for h in header]])
    return ordered.select(F.col("line").cast("long"), "value").mapInPandas(parsed, schema)


def split_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Rows of a delimited file with a header, all text; order doesn't count, so the scan is split."""
    df = spark.read.option("header", True).option("sep", sep).option("inferSchema", False).csv(path)
    return df.select([F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns])


def files(spark: SparkSession, path: str, glob: str | None = None, content: bool = False) -> DataFrame:
    """(path, length[, content]) of files below a path; a missing path is an error."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "length", *(["content"] if content else []))


def bundle(spark: SparkSession, path: str, pattern: str = ".*") -> DataFrame:
    """(name, path, length) of the members of a directory whose relative name matches; none is no error."""
    root = path.rstrip("/")
    df = files(spark, path).withColumn("name", F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), "^" + root.replace(".", "[.]").replace("file://", "") + "/", ""))
    return df.where(F.col("name").rlike(pattern)).select("name", "path", "length")


def templates(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True)


def parameter_schema(spark: SparkSession, path: str) -> DataFrame:
    """(grp, title, name, type, default, pattern, enum, hidden, required) of a JSON schema's groups and ungrouped properties; empty if it can't be read."""
    properties = "map<string, struct<type: string, description: string, `default`: string, pattern: string, `enum`: array<string>, hidden: boolean>>"
    group = f"required: array<string>, properties: {properties}"
    ddl = f"definitions map<string, struct<title: string, {group}>>, {group.replace(': ', ' ', 1).replace('properties: ', 'properties ')}"
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", ddl).alias("j"))
    grouped = text.select(F.explode("j.definitions").alias("g", "d")).select(F.coalesce("d.title", "g").alias("grp"), F.col("d.required").alias("req"), F.explode("d.properties").alias("name", "p"))
    single = text.select(F.lit("Other parameters").alias("grp"), F.col("j.required").alias("req"), F.explode("j.properties").alias("name", "p"))
    both = grouped.unionByName(single)
    return both.select(
        "grp",
        F.col("p.description").alias("title"),
        "name",
        F.col("p.type").alias("type"),
        F.col("p.default").alias("default"),
        F.col("p.pattern").alias("pattern"),
        F.coalesce("p.enum", F.array().cast("array<string>")).alias("enum"),
        F.coalesce("p.hidden", F.lit(False)).alias("hidden"),
        F.coalesce(F.array_contains("req", F.col("name")), F.lit(False)).alias("required"),
    )


def version_documents(spark: SparkSession, path: str) -> DataFrame:
    """(process, tool, version) of two-level documents ("process:" lines, indented "tool: version" lines); every scalar stays text.

    Later documents and keys win, by path and position.
    """
    lines = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.split("value", r"\r?\n")).alias("pos", "text"))

    def parsed(pdf: pd.DataFrame) -> pd.DataFrame:
        process, out = None, []
        for pos, text in sorted(zip(pdf["pos"], pdf["text"])):
            bare = text.split(" #")[0].rstrip()
            if not bare.strip() or bare.lstrip().startswith("#"):
                continue
            key, _, value = (bare.rpartition(":") if not bare.startswith((" ", "\t")) else bare.partition(":"))
            key, value = key.strip().strip("\"'"), value.strip().strip("\"'")
            if not bare.startswith((" ", "\t")):
                process = key
            else:
                out.append((pdf["file"].iloc[0], int(pos), process, key, value))
        return pd.DataFrame(out, columns=["file", "pos", "process", "tool", "version"])

    rows = lines.groupBy("file").applyInPandas(parsed, "file string, pos int, process string, tool string, version string")
    last = rows.groupBy("process").agg(F.max("file").alias("file"))  # a process's later document replaces the earlier
    return rows.join(last, ["process", "file"]).groupBy("process", "tool").agg(F.max_by("version", "pos").alias("version"))


def catalogue(spark: SparkSession, path: str) -> DataFrame:
    """(key, attr, value) of a catalogue {"genome": {"attribute": "value"}} in JSON, all text."""
    df = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string, map<string, string>>")).alias("key", "attrs"))
    return df.select("key", F.explode("attrs").alias("attr", "value"))


def unpacked(spark: SparkSession, path: str) -> DataFrame:
    """(archive, name, content) of the members of zip archives."""

    def members(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, content in zip(b["path"], b["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for n in z.namelist():
                        if not n.endswith("/"):
                            yield pd.DataFrame({"archive": [p], "name": [n], "content": [z.read(n)]})

    return files(spark, path, content=True).select("path", "content").mapInPandas(members, "archive string, name string, content binary")


def layered(spark: SparkSession, layers: list[tuple[str, bool]]) -> DataFrame:
    """(name, value) of JSON objects of scalars, later layers winning; layers: (path, optional), a missing optional one only warns."""
    out = spark.createDataFrame([], "layer int, name string, value string")
    for i, (path, optional) in enumerate(layers):

        def read(path: str = path, i: int = i) -> DataFrame:
            own = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string, string>")).alias("name", "value"))
            return own.select(F.lit(i).alias("layer"), "name", "value")

        out = out.unionByName(optional_layer(read, out.limit(0)) if optional else read())
    return out.groupBy("name").agg(F.max_by("value", "layer").alias("value"))


def optional_layer(read, default: DataFrame) -> DataFrame:  # noqa: ANN001
    """What read() gives, or the default, with a warning, if the layer can't be had."""
    import warnings

    try:
        return read()
    except Exception as e:  # a missing layer is allowed, whatever keeps it away
        warnings.warn(f"could not load an optional layer: {e}", stacklevel=2)
        return default
