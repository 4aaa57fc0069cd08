"""Labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import staged


def labelled(docs: DataFrame, labels: DataFrame, label: Column, is_train: Column, max_rows: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, text, _label): a text of each of at most max_rows labelled ids, chosen by a hash of the id.

    Null labels and ids count for nothing; of several labels for one id the largest
    holds, of several texts for one id that with the smallest hash. The sample's size
    is bounded, so its ids are broadcast to the scan, and it is written once.
    """
    own = labels.select(F.col(id_col).alias("_id"), label.alias("_label")).where("_id is not null and _label is not null")
    own = own.groupBy("_id").agg(F.max("_label").alias("_label"))
    own = own.withColumnRenamed("_id", id_col).where(is_train).withColumnRenamed(id_col, "_id").withColumn("_h", F.xxhash64("_id"))
    # of very many labels only the smallest hashes, some more than are wanted, go to the sort
    share = min(1.0, (1.5 * max_rows + 1000) / max(1, own.count()))
    few = own if share == 1.0 else own.where(F.col("_h") <= int((share - 0.5) * 2**64))
    chosen = few.orderBy("_h", "_id").limit(max_rows)
    found = docs.select(F.col(id_col).alias("_own"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), F.col("_own") == F.col("_id"))
    one = found.groupBy("_id").agg(F.min_by("_text", F.xxhash64("_text")).alias("text"), F.first("_label").alias("_label"))
    return staged(one.select(F.col("_id").alias(id_col), "text", "_label"), "labelled")
