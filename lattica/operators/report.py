"""Run summaries, report sections, resource requests and process shells."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions import scalars as S


def run_summary(tasks: DataFrame, *by: str) -> DataFrame:
    """(by..., ok, ignored, failed, status) of tasks (state, ignored)."""
    out = tasks.groupBy(*by).agg(F.count_if("ok").alias("n_ok"), F.count_if("ignored").alias("n_ignored"), F.count_if(~F.col("ok") & ~F.col("ignored")).alias("n_failed"))
    status = F.when(F.col("n_failed") > 0, "failed").when(F.col("n_ignored") > 0, "completed with errors").otherwise("success")
    return out.withColumn("status", status)


def log_summary(runs: DataFrame, workflow: str, monochrome: Column) -> DataFrame:
    """runs (n_failed, n_ignored, ...) with `line`, what the log tells at the end, coloured unless monochrome."""

    def c(name: str) -> Column:
        return S.colour(F.lit(name), monochrome)

    done = F.when(F.col("n_failed") > 0, F.concat(c("red"), F.lit(" Pipeline completed with errors")))
    done = done.when(F.col("n_ignored") > 0, F.concat(c("yellow"), F.lit(" Pipeline completed successfully, but with errored process(es) "))).otherwise(F.concat(c("green"), F.lit(" Pipeline completed successfully")))
    return runs.withColumn("line", F.concat(F.lit("-"), c("purple"), F.lit(f"[{workflow}]"), done, c("reset"), F.lit("-")))


def trace(tasks: DataFrame) -> DataFrame:
    """The execution trace of tasks (task_id, name, inputs, exit, submit, complete): identity, status and times, in order of their ids when written."""
    key = F.md5(F.concat_ws("|", "name", "inputs"))
    status = F.when(F.col("exit").isNull(), "ABORTED").when(F.col("exit") == 0, "COMPLETED").otherwise("FAILED")
    return tasks.select("task_id", F.concat(F.substring(key, 1, 2), F.lit("/"), F.substring(key, 3, 6)).alias("hash"), "name", status.alias("status"), "exit", "submit", (F.col("complete").cast("double") - F.col("submit").cast("double")).alias("duration"))


def assembled(spark: SparkSession, tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(section, sample, metric, value) of all metric tables, each with the name of its sample column; null metrics are left out."""
    out = spark.createDataFrame([], "section string, sample string, metric string, value double")
    for name, (df, sample) in tables.items():
        metrics = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in df.columns if c != sample])
        long = df.select(F.lit(name).alias("section"), F.col(sample).cast("string").alias("sample"), F.explode(metrics).alias("m"))
        out = out.unionByName(long.select("section", "sample", "m.metric", "m.value").where("value is not null"))
    return out


def sections(df: DataFrame, weight: str, group: str, item: str) -> DataFrame:
    """(group, html): definition lists of each group, by descending weight of their items; empty values are N/A."""
    entry = F.concat(F.lit("<dt>"), F.col(item), F.lit("</dt><dd><samp>"), S.or_else(F.col("value"), F.lit("N/A")), F.lit("</samp></dd>"))
    rows = F.transform(F.sort_array(F.collect_list(F.struct((-F.col(weight)).alias("w"), F.col(item).alias("i"), entry.alias("e")))), lambda s: s["e"])
    return df.groupBy(group).agg(F.array_join(rows, "\n").alias("html"))


def requests(tasks: DataFrame, base: dict[str, float], caps: dict[str, Column]) -> DataFrame:
    """tasks (attempt) with each resource's base times the attempt, capped."""
    return tasks.withColumns({k: S.capped(S.scaled(F.lit(v), F.col("attempt")), caps.get(k, F.lit(None).cast("double"))) for k, v in base.items()})


def process_shell(files: DataFrame, tool: Callable, schema: str) -> DataFrame:
    """A table function over binary files (path, content): `tool` maps pandas frames to frames of the schema."""
    return files.select("path", "content").mapInPandas(tool, schema)


def stub(spark: SparkSession, schemas: dict[str, str]) -> dict[str, DataFrame]:
    """Empty outputs of the declared shapes."""
    return {name: spark.createDataFrame([], ddl) for name, ddl in schemas.items()}


def components_of_mask(batches):  # noqa: ANN001, ANN201
    """A tool for process_shell: (path, label, n, cx, cy) of 4-connected regions of .npy masks; a stand-in, no segmentation."""
    import io

    import numpy as np
    import pandas as pd

    for b in batches:
        out = []
        for path, content in zip(b["path"], b["content"]):
            mask = np.pad(np.load(io.BytesIO(content)) > 0, 1)
            # the least index of a region spreads to its neighbours until nothing changes
            label = np.where(mask, np.arange(mask.size).reshape(mask.shape), mask.size)
            while True:
                near = np.minimum.reduce([label, np.roll(label, 1, 0), np.roll(label, -1, 0), np.roll(label, 1, 1), np.roll(label, -1, 1)])
                new = np.where(mask, near, mask.size)
                new = np.where(mask, np.r_[new.ravel(), mask.size][new], mask.size)
                if (new == label).all():
                    break
                label = new
            _, k = np.unique(label[mask], return_inverse=True)
            ys, xs = np.nonzero(mask)
            n = np.bincount(k)
            cx, cy = np.bincount(k, xs - 1) / np.maximum(n, 1), np.bincount(k, ys - 1) / np.maximum(n, 1)
            out += [(path, i + 1, int(n[i]), float(cx[i]), float(cy[i])) for i in range(len(n))]
        yield pd.DataFrame(out, columns=["path", "label", "n", "cx", "cy"])
