"""Helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracast.shipping import ship

#: Documents, and bytes of their texts, that a task holds as Python objects at once.
BATCH_ROWS, BATCH_BYTES = 512, 1 << 20
_ROWS, _BYTES = (f"spark.sql.execution.arrow.max{what}PerBatch" for what in ("Records", "Bytes"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ready_workers(spark: SparkSession) -> None:
    """This package on the workers, and batches that suit rows with whole texts.

    Spark hands Python 10,000 rows, or 64 MB, at a time, and holds them several times over in the
    executor and in its worker. Unless the session has a limit of its own, this lowers the bytes and
    leaves the rows: tables of narrow rows have their batches as before.
    """
    ship(spark)
    if not {_ROWS, _BYTES} & set(spark.conf.getAll):
        spark.conf.set(_BYTES, str(4 * BATCH_BYTES))


def give_back() -> None:
    """Returns memory that a task freed to the system, which its worker outlives the task with."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps it
        pass


def in_arrow(df: DataFrame, run, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package on the workers."""
    ready_workers(df.sparkSession)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(whole, schema)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of ``BATCH_ROWS`` rows and ``BATCH_BYTES`` of texts at most, or of one row."""
    sizes = np.zeros(batch.num_rows, dtype=np.int64)
    for column in batch.columns:
        if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
            sizes += pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends, first = sizes.cumsum(), 0
    while first < batch.num_rows:
        limit = (ends[first - 1] if first else 0) + BATCH_BYTES
        last = min(int(np.searchsorted(ends, limit, "right")), first + BATCH_ROWS, batch.num_rows)
        last = max(last, first + 1)
        yield batch.slice(first, last - first)
        first = last


def map_batches(
    df: DataFrame, build: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str
) -> DataFrame:
    """Rows through ``build()(batch)``, a few hundred at a time; ``build`` runs once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = build()
        for batch in batches:
            for part in slices(batch):
                out = work(part)
                if out.num_rows:
                    yield out

    return in_arrow(df, run, schema)


def bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a missing id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(n))


def labelled(labels: DataFrame, label: str, usable: Column, bound: int) -> DataFrame:
    """(doc_id, label) of usable rows: one per id, the larger label where they differ.

    A hash of the id picks the rows where there are more than ``bound``, so that about ``bound``
    remain. Rows without an id, or with a label other than 0 and 1, are left out.
    """
    rows = (
        labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & usable)
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    n, scale = rows.count(), 1 << 30
    if n <= bound:
        return rows
    return rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(scale)) < F.lit(scale * bound // n))


def row_key(df: DataFrame, text: str = "text") -> Column:
    """With the id, tells rows apart that share an id but not their text."""
    return F.xxhash64(F.coalesce(df[text], F.lit("")))
