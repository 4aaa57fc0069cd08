"""Parameters against a declarative schema.

Tables: params (name, value string, type), schema (grp, title, name, type,
default, pattern, enum array<string>, hidden, required).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lattica.functions import scalars as S

# Options of the launcher itself, which parameters must not be named after.
RESERVED = (
    "bg", "c", "C", "config", "d", "D", "dockerize", "h", "log", "q", "quiet", "syslog", "v",
    "ansi", "ansi-log", "bucket-dir", "cache", "dsl2", "dump-channels", "dump-hashes", "E", "entry", "latest", "lib", "main-script", "N", "name", "offline",
    "params-file", "pi", "plugins", "poll-interval", "pool-size", "profile", "ps", "qs", "queue-size", "r", "resume", "revision", "stdin", "stub", "stub-run", "test", "w",
    "with-charliecloud", "with-conda", "with-dag", "with-docker", "with-mpi", "with-notification", "with-podman", "with-report", "with-singularity", "with-timeline", "with-tower", "with-trace", "with-weblog",
    "without-docker", "without-podman", "work-dir",
)


def normalised(name: Column) -> Column:
    """A name without hyphens, in lower case."""
    return F.lower(F.replace(name, F.lit("-"), F.lit("")))


def reserved(params: DataFrame, names: tuple[str, ...] = RESERVED) -> DataFrame:
    """Parameters named after a launcher option."""
    return params.where(F.col("name").isin(*names))


def unexpected(params: DataFrame, schema: DataFrame, ignore: DataFrame, order: str) -> DataFrame:
    """(name) of parameters that are neither in the schema nor ignored.

    A hyphenated variant of an expected name isn't unexpected; of names alike but
    for hyphens and case the first by `order` is told.
    """
    expected = schema.select("name").distinct()
    variants = expected.select(normalised(F.col("name")).alias("_n")).distinct()
    rest = params.join(expected, "name", "left_anti").join(ignore.select("name"), "name", "left_anti").withColumn("_n", normalised(F.col("name")))
    hyphen = rest.where(F.contains("name", F.lit("-"))).join(variants, "_n", "left_anti")
    plain = rest.where(~F.contains("name", F.lit("-")))
    first = hyphen.unionByName(plain, allowMissingColumns=True).groupBy("_n").agg(F.min_by("name", F.struct(order, "name")).alias("name"))
    return first.select("name")


def cleaned(params: DataFrame) -> DataFrame:
    """Parameters whose value is truthy, as text; 0 and false count as absent, durations spell out days."""
    value = F.col("value")
    on = F.when(F.col("type").isin("integer", "number"), F.coalesce(value.try_cast("double") != 0, F.lit(False))).when(F.col("type") == "boolean", S.to_boolean(value)).otherwise(S.truthy(value))
    return params.where(on).withColumn("value", F.when(F.col("type") == "duration", S.day_unit(value)).otherwise(value))


def without_ignored(schema: DataFrame, ignore: DataFrame) -> DataFrame:
    return schema.join(ignore.select("name"), "name", "left_anti")


def violations(params: DataFrame, schema: DataFrame) -> DataFrame:
    """(name, error) for missing required parameters, wrong types, values outside an enum and patterns not met, in that order of checks."""
    j = schema.withColumnRenamed("type", "want").join(params.select("name", "value"), "name", "left")
    v = F.col("value")
    typed = F.when(F.col("want") == "integer", v.try_cast("long").isNotNull() & v.rlike(r"^[+-]?[0-9]+$")).when(F.col("want") == "number", v.try_cast("double").isNotNull()).when(F.col("want") == "boolean", v.isin("true", "false")).otherwise(True)
    error = F.coalesce(
        F.when(v.isNull() & F.col("required"), F.concat(F.lit("* Missing required parameter: --"), F.col("name"))),
        F.when(v.isNotNull() & ~typed, F.concat(F.lit("* --"), F.col("name"), F.lit(": expected type: "), F.col("want"), F.lit(" ("), v, F.lit(")"))),
        F.when(v.isNotNull() & (F.size("enum") > 0) & ~F.array_contains("enum", v), enum_message(F.col("name"), v, F.col("enum"))),
        F.when(v.isNotNull() & F.col("pattern").isNotNull() & ~F.regexp(v, F.col("pattern")), F.concat(F.lit("* --"), F.col("name"), F.lit(": does not match pattern "), F.col("pattern"), F.lit(" ("), v, F.lit(")"))),
    )
    return j.select("name", error.alias("error")).where("error is not null")


def enum_message(name: Column, value: Column, enum: Column, limit: int = 5) -> Column:
    """The message for a value that is no choice; at most `limit` choices are shown."""
    head = F.concat(F.lit("* --"), name, F.lit(": '"), value, F.lit("' is not a valid choice (Available choices"))
    few = F.concat(head, F.lit(": "), F.array_join(enum, ", "), F.lit(")"))
    many = F.concat(head, F.lit(f" ({limit} of "), F.size(enum).cast("string"), F.lit("): "), F.array_join(F.slice(enum, 1, limit), ", "), F.lit(", ... )"))
    return F.when(F.size(enum) > limit, many).otherwise(few)


def differs(value: Column, default: Column) -> Column:
    """Whether a value isn't the default; without a default: isn't null, empty or false. 0 does count."""
    return F.when(default.isNotNull(), ~value.eqNullSafe(default)).otherwise(value.isNotNull() & ~value.isin("", "false"))


def summary(params: DataFrame, schema: DataFrame, outdir: Column) -> DataFrame:
    """(grp, name, value) of parameters that differ from their defaults, project and output folders being substituted."""
    d = F.col("default")
    project = F.replace(F.replace(d, F.lit("$projectDir"), F.lit("")), F.lit("${projectDir}"), F.lit(""))
    under = F.replace(F.replace(d, F.lit("$params.outdir"), F.lit("")), F.lit("${params.outdir}"), F.lit(""))
    same = (F.col("want") == "string") & (((project != d) & F.contains("value", project)) | ((under != d) & (F.concat(outdir, under) == F.col("value"))))
    j = schema.withColumnRenamed("type", "want").join(params.select("name", "value"), "name")
    return j.where(differs(F.col("value"), d) & ~F.coalesce(same, F.lit(False))).select("grp", "name", "value")


def help_lines(schema: DataFrame, width: int, show_hidden: bool = False) -> DataFrame:
    """(grp, name, text) of the help: padded names and types, wrapped descriptions; hidden ones only if asked."""
    longest = schema.agg(F.max(F.length("name")).alias("_n"))
    shown = schema.where(F.lit(show_hidden) | ~F.coalesce("hidden", F.lit(False))).crossJoin(F.broadcast(longest))
    text = F.concat(F.coalesce("title", F.lit("")), F.when(F.col("default").isNotNull(), F.concat(F.lit(" [default: "), F.col("default"), F.lit("]"))).otherwise(""))
    head = F.concat(F.lit("  --"), S.pad_right(F.col("name"), F.col("_n")), S.pad_right(F.concat(F.lit("["), F.col("type"), F.lit("]")), F.lit(10)))
    return shown.select("grp", "name", F.concat(head, F.array_join(S.wrapped(text, width), "\n")).alias("text"))


def counts_by_group(schema: DataFrame) -> DataFrame:
    """(grp, shown, hidden) of groups that show something."""
    return schema.groupBy("grp").agg(F.count_if(~F.coalesce("hidden", F.lit(False))).alias("shown"), F.count_if(F.coalesce("hidden", F.lit(False))).alias("hidden")).where("shown > 0")


def channels_violate(channels: Column, required: tuple[str, ...] = ("conda-forge", "bioconda", "defaults")) -> Column:
    """Whether required channels are missing, or not in their order; a missing one stands before all."""
    want = F.array(*map(F.lit, required))
    at = [F.coalesce(F.array_position(channels, r), F.lit(0)) for r in required]
    bad = F.size(F.array_except(want, channels)) > 0
    for a, b in zip(at, at[1:]):
        bad = bad | ~(a < b)
    return bad


def leaf_errors(errors: DataFrame) -> DataFrame:
    """Of a tree of errors (id, parent, message, ...), those that no other error causes, with their depth from the roots."""
    spark = errors.sparkSession
    errors.createOrReplaceTempView("_lattica_errors")
    leaves = spark.sql(
        """
        WITH RECURSIVE walk(id, depth) AS (
            SELECT id, 0 FROM _lattica_errors WHERE parent IS NULL
            UNION ALL
            SELECT e.id, w.depth + 1 FROM _lattica_errors e JOIN walk w ON e.parent = w.id)
        SELECT w.id, w.depth FROM walk w LEFT ANTI JOIN _lattica_errors e ON e.parent = w.id
        """
    )
    return leaves.join(errors.drop("parent"), "id")


def required_without(required: Column, ignore: Column) -> Column:
    """A group's required names without ignored ones; null stays null."""
    return F.array_except(required, ignore)


def parameter_of(pointer: Column) -> Column:
    """The parameter that a violation's pointer names."""
    return F.regexp_replace(pointer, "^#/", "")


def missing_key(message: Column) -> Column:
    """The key that a message reports as missing, null if it is another message."""
    key = F.regexp_extract(message, r"^required key \[([^\]]+)\] not found$", 1)
    return F.when(F.length(key) > 0, key)


def error_messages(leaves: DataFrame, params: DataFrame, enums: DataFrame, limit: int = 5) -> DataFrame:
    """(id, error) of leaf errors (id, message, pointer): a missing parameter, an error of all, a choice that isn't one, or a value's error.

    params: (name, value); enums: (name, enum) of the parameters with choices.
    """
    named = leaves.withColumn("name", parameter_of(F.col("pointer")))
    j = named.join(params.select("name", "value"), "name", "left").join(enums.select("name", "enum"), "name", "left")
    key, value = missing_key(F.col("message")), F.coalesce("value", F.lit("null"))
    error = (
        F.when(key.isNotNull(), F.concat(F.lit("* Missing required parameter: --"), key))
        .when(F.col("pointer") == "#", F.concat(F.lit("* "), F.col("message")))
        .when(F.col("enum").isNotNull(), enum_message(F.col("name"), value, F.col("enum"), limit))
        .otherwise(F.concat(F.lit("* --"), F.col("name"), F.lit(": "), F.col("message"), F.lit(" ("), value, F.lit(")")))
    )
    return j.select("id", error.alias("error"))


def first_per(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key by `order`."""
    return df.withColumn("_r", F.row_number().over(W.partitionBy(key).orderBy(*order))).where("_r = 1").drop("_r")
