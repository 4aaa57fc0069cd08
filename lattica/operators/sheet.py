"""Sample sheets: validation with the first error, pairing, numbering and parsing.

Input columns: `line` (long, unique), sample, fastq_1, fastq_2 (strings; null is
as empty), and any others, which are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lattica.functions import scalars as S

REQUIRED = ("sample", "fastq_1", "fastq_2")
FORMATS = (".fq.gz", ".fastq.gz")


def missing_columns(header: list[str], required: tuple[str, ...] = REQUIRED) -> list[str]:
    """The required columns that a header lacks, in their order."""
    return [c for c in required if c not in header]


def require_columns(df: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """df, or an error that names what is missing; further columns are allowed."""
    missing = missing_columns(df.columns, required)
    if missing:
        raise ValueError(f"The sample sheet must contain these column headers: {', '.join(required)}; missing: {', '.join(missing)}")
    return df


def _text(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def _format_ok(c: Column) -> Column:
    return F.endswith(c, F.lit(FORMATS[0])) | F.endswith(c, F.lit(FORMATS[1]))


def single_end() -> Column:
    return ~((F.length(_text("fastq_1")) > 0) & (F.length(_text("fastq_2")) > 0))


def sanitised() -> Column:
    """The sample with spaces, and only those, as underscores."""
    return F.replace(_text("sample"), F.lit(" "), F.lit("_"))


def row_error() -> Column:
    """The first failing check of a row, null if none: sample, first file, second file, pair.

    Fixed values: the messages.
    """
    f1, f2 = _text("fastq_1"), _text("fastq_2")

    def odd(c: Column) -> Column:
        return F.concat(F.lit("The FASTQ file has an unrecognized extension: "), c)

    return F.coalesce(
        F.when(F.length(_text("sample")) == 0, F.lit("Sample input is required.")),
        F.when(F.length(f1) == 0, F.lit("At least the first FASTQ file is required.")),
        F.when(~_format_ok(f1), odd(f1)),
        F.when((F.length(f2) > 0) & ~_format_ok(f2), odd(f2)),
        F.when(~single_end() & (S.suffixes(f1) != S.suffixes(f2)), F.lit("FASTQ pairs must have the same file extensions.")),
    )


def errors(df: DataFrame) -> DataFrame:
    """(line, error) of every failing row."""
    return df.select("line", row_error().alias("error")).where("error is not null")


def first_error(df: DataFrame) -> DataFrame:
    """One row (line, error) if any row fails: the failure with the smallest line."""
    return errors(df).agg(F.min(F.struct("line", "error")).alias("e")).where("e is not null").select("e.line", "e.error")


def duplicates(df: DataFrame) -> DataFrame:
    """(sample, fastq_1, n) of sample and first file that occur more than once; the second file doesn't matter."""
    return df.select(sanitised().alias("sample"), _text("fastq_1").alias("fastq_1")).groupBy("sample", "fastq_1").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def validated(df: DataFrame) -> DataFrame:
    """Rows with `single_end` second, and samples numbered _T1, _T2, ... in line order."""
    rank = F.row_number().over(W.partitionBy("_s").orderBy("line"))
    out = df.withColumn("_s", sanitised()).withColumns({"_name": F.concat(F.col("_s"), F.lit("_T"), rank.cast("string")), "_single": single_end()})
    rest = [c for c in df.columns if c not in ("line", "sample", "single_end")]
    return out.select("line", F.col("_name").alias("sample"), F.col("_single").alias("single_end"), *rest)


def strict(df: DataFrame) -> DataFrame:
    """validated(), failing at run time with the first row error or the duplicates."""
    first = first_error(df).select(F.lit(0).alias("rank"), F.concat(F.col("error"), F.lit(" On line "), (F.col("line") + 2).cast("string"), F.lit(".")).alias("m"))
    twice = duplicates(df).limit(1).select(F.lit(1).alias("rank"), F.lit("The pair of sample name and FASTQ must be unique.").alias("m"))
    bad = first.unionByName(twice).agg(F.min_by("m", "rank").alias("_bad"))  # a row's error is told before a pair's
    return validated(df).crossJoin(F.broadcast(bad)).where(F.when(F.col("_bad").isNotNull(), F.raise_error(F.col("_bad")).cast("boolean")).otherwise(True)).drop("_bad")


def reads(df: DataFrame) -> DataFrame:
    """(meta struct<id, single_end>, reads array of one or two paths) of a validated sheet, whose single_end may be text."""
    single = S.to_boolean(F.col("single_end").cast("string"))
    meta = F.struct(F.col("sample").alias("id"), single.alias("single_end"))
    return df.select(meta.alias("meta"), F.when(single, F.array("fastq_1")).otherwise(F.array("fastq_1", "fastq_2")).alias("reads"))


def missing_files(parsed: DataFrame, listing: DataFrame) -> DataFrame:
    """(path) of reads that the listing (path) doesn't have."""
    return parsed.select(F.explode("reads").alias("path")).distinct().join(listing.select("path"), "path", "left_anti")
