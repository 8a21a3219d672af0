"""The stages that keep no state, on a stream; those that need a whole sheet, batch by batch.

Columns built by ``functions`` and ``operators`` are the same for both kinds of tables. Keeping the best of equal comments needs all rows of
a sheet, so a stream applies it within each micro-batch: a source should deliver a sheet in one batch (for instance one file a trigger).
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from reviewflow.operators import dedup, headers
from reviewflow.operators.rules import deletion_reason


def standardized_stream(stream: DataFrame, ref: date, keep: list[str]) -> DataFrame:
    return headers.standardized(stream, ref, keep)


def kept_by_rules(stream: DataFrame, comment: str, clean_words: list[str] | None = None) -> DataFrame:
    """Rows that no deletion rule meets; the rules look at one row only."""
    return stream.where(deletion_reason(dedup.stripped_comment(F.col(f"`{comment}`")), clean_words).isNull())


def cleaned_batches(stream: DataFrame, path: str, sheet: list[str], order: list[str], comment: str, likes: str | None) -> DataStreamWriter:
    """Each micro-batch through the whole cleaning stage; a batch's folder is replaced if the batch is repeated after a failure."""

    def write(batch: DataFrame, number: int) -> None:
        dedup.clean_rows(batch, sheet, order, comment, likes).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write)
