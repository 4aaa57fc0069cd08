"""Dataflow operators: channels are bags of rows, value channels one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lattica.functions import scalars as S

#: Rows up to which the side of a product is broadcast.
MAX_SIDE_ROWS = 10_000


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema)


def value(spark: SparkSession, item: tuple, schema: str) -> DataFrame:
    """A singleton, to be read any number of times."""
    return spark.createDataFrame([item], schema)


def of(spark: SparkSession, items: list, schema: str) -> DataFrame:
    return spark.createDataFrame(items, schema)


def mix(*channels: DataFrame) -> DataFrame:
    """All items of all channels; duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b), channels)


def unique(channel: DataFrame) -> DataFrame:
    return channel.distinct()


def first(channel: DataFrame, *order: str) -> DataFrame:
    """One item: the least by `order`."""
    return channel.orderBy(*order).limit(1)


def collected(channel: DataFrame, item: str, *order: str) -> DataFrame:
    """One row with the array `items`, in order; [] of an empty channel."""
    keys = F.sort_array(F.collect_list(F.struct(*order, F.col(item).alias("_item"))))
    return channel.agg(F.transform(keys, lambda s: s["_item"]).alias("items"))


def combine(left: DataFrame, side: DataFrame) -> DataFrame:
    """Every pair with a side channel; one of at most MAX_SIDE_ROWS rows is broadcast."""
    return left.crossJoin(F.broadcast(side) if side.limit(MAX_SIDE_ROWS + 1).count() <= MAX_SIDE_ROWS else side)


def joined_by_key(key: str, *channels: DataFrame) -> DataFrame:
    """Inputs of one task: rows of several channels that share a key."""
    return reduce(lambda a, b: a.join(b, key), channels)


def when(channel: DataFrame, condition: Column) -> DataFrame:
    """Items whose condition isn't false; null counts as true."""
    return channel.where(F.coalesce(condition, F.lit(True)))


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def appended(items: Column, *more: Column) -> Column:
    """An array with further items at its end; a null array counts as empty."""
    return F.when(items.isNull(), F.array(*more)).otherwise(F.concat(items, F.array(*more)))


def contains_all(items: Column, required: tuple[str, ...]) -> Column:
    """Whether an array has all required items."""
    return F.size(F.array_except(F.array(*map(F.lit, required)), items)) == 0


def content_key(*columns: str) -> Column:
    """The key of a task's cached output: a hash of the names and values of its inputs."""
    return F.sha2(F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"}), 256)


def resumed(inputs: DataFrame, cached: DataFrame, *columns: str) -> tuple[DataFrame, DataFrame]:
    """What a resumed run has to do: inputs without a cached output, and inputs with it; cached: (key, output...)."""
    keyed = inputs.withColumn("key", content_key(*columns))
    return keyed.join(cached.select("key"), "key", "left_anti"), keyed.join(cached, "key")


def with_extensions(tasks: DataFrame, extensions: DataFrame) -> DataFrame:
    """tasks (process, id) that run, with args and prefix from extensions (process, args, prefix, enabled).

    A null prefix or an empty one gives the id, missing args give none; a task runs unless enabled is false.
    """
    j = tasks.join(extensions.select("process", F.col("args").alias("_a"), F.col("prefix").alias("_p"), F.col("enabled").alias("_e")), "process", "left")
    return when(j, F.col("_e")).withColumns({"args": S.or_else(F.col("_a"), F.lit("")), "prefix": S.or_else(F.col("_p"), F.col("id"))}).drop("_a", "_p", "_e")


def overlay(rows: DataFrame, key: str, order: str, *ties: str) -> DataFrame:
    """For each key the row of the last layer; later layers win whole rows.

    An aggregate, not a window: layers of one key are merged before the shuffle.
    """
    others = [c for c in rows.columns if c != key]
    best = F.max_by(F.struct(*others), F.struct(order, *ties))
    return rows.groupBy(key).agg(best.alias("_r")).select(key, *[F.col("_r")[c].alias(c) for c in others])
