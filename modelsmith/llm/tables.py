"""Reading the test tables, and Arrow helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one step of a task holds as Python objects.
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{data_dir}/{name}.parquet")


def held_out(doc_id: Column, mod: int, rest: int) -> Column:
    """Whether crc32 of the decimal id leaves ``rest`` modulo ``mod`` (a null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == rest, F.lit(False))


def blocks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Slices of the batches of about ``limit`` bytes of text, with the texts as a list (null stays None)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        start = 0
        while start < batch.num_rows:
            held, end = 0, start
            while end < batch.num_rows and (end == start or held < limit):
                held += len(column[end].as_buffer() or b"") if column[end].is_valid else 0
                end += 1
            yield batch.slice(start, end - start), column.slice(start, end - start).to_pylist()
            start = end
