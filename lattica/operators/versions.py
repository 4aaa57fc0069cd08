"""Software versions: consistency within a module, and the report table.

Table: (process, tool, version), the process fully qualified with colons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lattica.functions import scalars as S


def by_process(versions: DataFrame) -> DataFrame:
    """(module, process, versions json): a process's tools, in order, as one value."""
    tools = F.to_json(F.sort_array(F.collect_set(F.struct("tool", "version"))))
    return versions.groupBy("process").agg(tools.alias("versions")).withColumn("module", S.last_segment(F.col("process")))


def inconsistent(versions: DataFrame) -> DataFrame:
    """(module, variants) of modules whose processes don't all have the same versions."""
    return by_process(versions).groupBy("module").agg(F.count_distinct("versions").alias("variants")).where("variants > 1")


def modules(versions: DataFrame, check: bool = True) -> DataFrame:
    """(process, tool, version) by module name; differing versions within a module fail the job."""
    if check:
        bad = F.raise_error(F.lit("Software versions are assumed to be the same between all modules.")).cast("boolean")
        one = by_process(versions).groupBy("module").agg(F.count_distinct("versions").alias("n"), F.min("process").alias("process")).where(F.when(F.col("n") > 1, bad).otherwise(True)).select("process", "module")
    else:
        one = by_process(versions).groupBy("module").agg(F.min("process").alias("process"))
    return versions.join(one, "process").select(F.col("module").alias("process"), "tool", "version").distinct()


def labelled(versions: DataFrame) -> DataFrame:
    """(process, tool, version, label): in order, the label being the process on its first row and empty after."""
    first = F.row_number().over(W.partitionBy("process").orderBy("tool", "version")) == 1
    return versions.withColumn("label", F.when(first, F.col("process")).otherwise(""))


def with_workflow(versions: DataFrame, engine: tuple[str, str], workflow: tuple[str, str]) -> DataFrame:
    """versions with the entry Workflow: (name, version) of the engine and of the workflow; it replaces a module of that name."""
    own = versions.sparkSession.createDataFrame([("Workflow", *engine), ("Workflow", *workflow)], "process string, tool string, version string")
    return versions.where("process <> 'Workflow'").select("process", "tool", "version").unionByName(own)


def section_document(table: DataFrame, workflow: str, link: str) -> DataFrame:
    """(text): the report section's document around an HTML table (html)."""
    fields = (("id", "software_versions"), ("section_name", f"{workflow} Software Versions"), ("section_href", link), ("plot_type", "html"), ("description", "are collected at run time from the software output."))
    head = "".join(f"{k}: '{v}'\n" for k, v in fields)
    indented = F.regexp_replace("html", "(?m)^", "  ")
    return table.select(F.concat(F.lit(head + "data: |\n"), indented, F.lit("\n")).alias("text"))


# The markup of the table, and its style.
STYLE = "<style>\n#{id} tbody:nth-child(even) {{\n    background-color: #f2f2f2;\n}}\n</style>\n"


def html(versions: DataFrame, table_id: str | None = None) -> DataFrame:
    """One row with the HTML table of a report; with an id also its style."""
    row = F.format_string("<tr><td><samp>%s</samp></td><td><samp>%s</samp></td><td><samp>%s</samp></td></tr>", "label", "tool", "version")
    body = labelled(versions).groupBy("process").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("tool", "version", row.alias("row")))), lambda s: s["row"]), "\n").alias("rows"))
    all_rows = F.transform(F.sort_array(F.collect_list(F.struct("process", "rows"))), lambda s: F.concat(F.lit("<tbody>\n"), s["rows"], F.lit("\n</tbody>")))
    style, own = (STYLE.format(id=table_id), f' id="{table_id}"') if table_id else ("", "")
    head = f'{style}<table class="table" style="width:100%"{own}>\n<thead><tr><th> Process Name </th><th> Software </th><th> Version  </th></tr></thead>\n'
    return body.agg(F.concat(F.lit(head), F.array_join(all_rows, "\n"), F.lit("\n</table>")).alias("html"))
