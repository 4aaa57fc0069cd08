"""Streaming: a growing folder of sheets as a channel, event counts with lateness, completion callbacks.

The event-time operators are extras: the workflow this engine serves has none.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from lattica.operators import sheet


def sheets(spark: SparkSession, folder: str, sep: str = ",", columns: str = "sample string, fastq_1 string, fastq_2 string") -> DataFrame:
    """Rows of the CSV files that arrive in a folder, with their file."""
    return spark.readStream.schema(columns).option("header", True).option("sep", sep).csv(folder).withColumn("file", F.col("_metadata.file_path"))


def checked(rows: DataFrame) -> DataFrame:
    """rows with single_end and error; numbering needs a whole sheet and is left to the batch that holds it."""
    return rows.withColumns({"error": sheet.row_error(), "sample": sheet.sanitised(), "single_end": sheet.single_end()})


def event_counts(events: DataFrame, time: str, key: str, size: str, late: str) -> DataFrame:
    """(window, key, n) per tumbling window; events later than `late` are dropped."""
    return events.withWatermark(time, late).groupBy(F.window(time, size), key).agg(F.count(F.lit(1)).alias("n"))


class OnComplete(StreamingQueryListener):
    """Calls back when a query ends, with its error or None."""

    def __init__(self, callback: Callable[[str, str | None], None]) -> None:
        self.callback = callback

    def onQueryStarted(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: ANN001, N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: ANN001, N802
        self.callback(str(event.id), event.exception)
