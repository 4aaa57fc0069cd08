"""Sinks: sheets, collected files, version documents, routed outputs, and delivery hooks."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions import scalars as S


def write_sheet(df: DataFrame, path: str, order: str = "line") -> None:
    """One CSV with a header, in order; booleans as True and False. A sheet is small by nature."""
    cols = [F.initcap(F.col(f.name).cast("string")).alias(f.name) if f.dataType.typeName() == "boolean" else F.col(f.name) for f in df.schema.fields if f.name != order]
    df.coalesce(1).sortWithinPartitions(order).select(*cols).write.mode("overwrite").option("emptyValue", "").csv(path, header=True)


def collect_file(df: DataFrame, column: str, path: str, *order: str) -> None:
    """All items as the lines of one file, in order."""
    df.coalesce(1).sortWithinPartitions(*order).select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)


def version_document(versions: DataFrame) -> DataFrame:
    """(process, text): a two-level document for each process, its tools in order."""
    lines = F.transform(F.sort_array(F.collect_list(F.struct("tool", "version"))), lambda s: F.concat(F.lit("  "), s["tool"], F.lit(": '"), s["version"], F.lit("'")))
    return versions.groupBy("process").agg(F.concat(F.col("process"), F.lit(":\n"), F.array_join(lines, "\n")).alias("text"))


def write_file(spark: SparkSession, path: str, content: str | bytes) -> None:
    """One small file with the given content, in any store that Spark opens; it replaces one of that name."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    stream.write(bytearray(content.encode() if isinstance(content, str) else content))
    stream.close()


def write_reports(spark: SparkSession, folder: str, html: str, text: str) -> None:
    """The run's report in both forms, pipeline_report.html and pipeline_report.txt."""
    for form, content in (("html", html), ("txt", text)):
        write_file(spark, f"{folder.rstrip('/')}/pipeline_report.{form}", content)


def append_versions(versions: DataFrame, path: str) -> None:
    """Adds a process's (process, tool, version) rows to the version table."""
    versions.select("process", "tool", "version").write.mode("append").parquet(path)


def publish(files: DataFrame, path: str) -> None:
    """File records (process, name, ...) by the folder of their process; version documents are left out."""
    routed(files).write.mode("overwrite").partitionBy("folder").parquet(path)


def routed(files: DataFrame) -> DataFrame:
    """files with `folder`, without version documents."""
    return files.where("name <> 'versions.yml'").withColumn("folder", S.publish_path(F.col("process")))


def version_files(files: DataFrame) -> DataFrame:
    return files.where(F.col("name").rlike("_versions[.]yml$"))


def deliver(row: dict, hook: Callable[[str], int]) -> bool:
    """Gives a payload to a caller's hook (a mailer, a web hook); whether it answered 200. Nothing is sent by default."""
    import warnings

    status = hook(json.dumps({k: "_hidden_" if k == "hook_url" else v for k, v in row.items()}, default=str))
    if status != 200:
        warnings.warn(f"the hook answered {status}", stacklevel=2)
    return status == 200
