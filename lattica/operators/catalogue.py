"""Genome catalogues: a long table (key, attr, value), all strings, from a parameter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(rows: DataFrame, catalogue: DataFrame, key: str, attr: str, out: str) -> DataFrame:
    """rows with the attribute of their key as `out`; null where the catalogue has none."""
    own = catalogue.where(F.col("attr") == attr).select(F.col("key").alias("_key"), F.col("value").alias(out))
    return rows.join(own, F.col(key) == F.col("_key"), "left").drop("_key")


def unknown(rows: DataFrame, catalogue: DataFrame, key: str) -> DataFrame:
    """Rows whose key is given but not in the catalogue."""
    return rows.where(F.length(key) > 0).join(catalogue.select(F.col("key").alias(key)).distinct(), key, "left_anti")


def require_known(rows: DataFrame, catalogue: DataFrame, key: str) -> DataFrame:
    """rows, failing on an unknown key with the keys there are."""
    keys = catalogue.agg(F.array_join(F.sort_array(F.collect_set("key")), ", ").alias("_keys"))
    known = catalogue.select(F.col("key").alias("_key")).distinct()
    j = rows.join(known, F.col(key) == F.col("_key"), "left").crossJoin(F.broadcast(keys))
    bad = (F.length(key) > 0) & F.col("_key").isNull()
    told = F.raise_error(F.concat(F.lit("Genome '"), F.col(key), F.lit("' not found. Available: "), F.col("_keys"))).cast("boolean")
    return j.where(F.when(bad, told).otherwise(True)).drop("_key", "_keys")
