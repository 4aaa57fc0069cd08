"""Helpers shared by the corpus operators.

Conventions that hold for every operator of this subpackage:

* An operator reads only the columns it is told to use and returns its key
  columns plus its own outputs, so extra columns of any name cannot clash.
* A null text counts as an empty text unless the operator says otherwise.
* Rows are never identified by their key: repeated rows give repeated results.
* Intermediate tables are written as Parquet to the folder all executors share
  (``spark.checkpoint.dir``), so a lost executor costs a re-read, not a re-run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from lattica.sources.shared import clear_staged, new_path, shared_dir, staged

__all__ = ["clear_staged", "new_path", "shared_dir", "staged"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` of an input folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def open_file(path: str, mode: str):  # noqa: ANN201
    """A file in any store that Arrow opens: to write ("w"), to read through ("r"), or from any place ("seek")."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path)
    if mode == "w":
        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
        return system.open_output_stream(name, compression=None)
    return system.open_input_file(name) if mode == "seek" else system.open_input_stream(name, compression=None)


#: Batches are cut into slices of about so many bytes before Python works on them.
SLICE_BYTES = 4 << 20


def slices(batch: pa.RecordBatch, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch, of about `size` bytes each if its rows are alike, and a row at least."""
    step = max(1, batch.num_rows * size // max(size, batch.nbytes))
    for i in range(0, batch.num_rows, step):
        yield batch.slice(i, step)


#: Spark bounds Arrow batches by rows alone; fewer rows bound the bytes of long texts that a task holds.
BATCH_ROWS = 1_000
_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """`mapInArrow` on batches of at most BATCH_ROWS rows.

    The bound is a setting of the session, read when a plan runs: it stays set, unless
    the session has a lower one. Other queries only get smaller batches by it.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_ROWS_CONF)) <= BATCH_ROWS:
        conf.set(_ROWS_CONF, str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """`mapInArrow` with a function from a batch to columns; `schema` is the DDL of the result."""
    fields = StructType.fromDDL(schema).fields
    names, types = [f.name for f in fields], [to_arrow_type(f.dataType, timestamp_utc=True) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                out = fn(batch)
                yield pa.RecordBatch.from_arrays([pa.array(out[n], type=t) for n, t in zip(names, types)], names=names)

    return map_arrow(df, run, schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch, null as empty."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


#: A key is hot if it has more than one in so many of all rows; so fewer keys than this are hot.
HOT_KEYS = 20_000


def join_hot(rows: DataFrame, keyed: DataFrame, key: str, weight: str, hot_keys: int = HOT_KEYS) -> DataFrame:
    """rows joined with keyed, one row for each key that has the number of its rows as `weight`; without that column.

    Rows of hot keys stay where they are and meet their keys in a broadcast of fewer
    than `hot_keys` rows; only the others are shuffled by the key. A null key has no
    partner, as in any inner join. keyed is read three times and should be staged.
    """
    total = keyed.agg(F.coalesce(F.sum(weight), F.lit(0))).first()[0]
    is_hot = F.col(weight) * F.lit(hot_keys) > F.lit(total)
    hot, other = F.broadcast(keyed.where(is_hot).drop(weight)), keyed.where(~is_hot).drop(weight)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(other, key))


#: Rows of a number and little more that are broadcast at most: some 100 MB in a task, however large the corpus.
BROADCAST_ROWS = 1_000_000


def only(rows: DataFrame, chosen: DataFrame, key: str) -> DataFrame:
    """rows joined with chosen, staged and with one row at most for each key; rows move only if chosen is too large to broadcast."""
    return rows.join(F.broadcast(chosen) if chosen.count() <= BROADCAST_ROWS else chosen, key)


def id_text(col) -> object:
    """An id as the text that the folds hash; null as empty."""
    return F.coalesce(col.cast("string"), F.lit(""))


def fold(col, n: int):
    """crc32 of the id's text modulo n."""
    return F.crc32(F.encode(id_text(col), "UTF-8")) % F.lit(n)
