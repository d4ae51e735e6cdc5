"""Token ids of a corpus in files of directly addressable codes, in ascending document order.

A file is a Parquet part whose rows are segments (``dac.py``) of whole documents: about
``SEGMENT_TOKENS`` ids, the documents' ids, and where each starts in its segment. Spark writes and
commits the parts, so any store that Spark writes will do and a lost task is written again.

* Documents are dealt by ranges of their id, then encoded: the text moves once, ids never.
* Global starts need one total per shard (range of ids); only those are summed in one place.

Null text counts as empty, a document without an id comes first, equal ids lie next to each
other in the order of their texts. An empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veracast.llm import dac
from veracast.llm.common import in_arrow
from veracast.llm.tokens import encoder
from veracast.sources.scratch import fresh_path

SEGMENT_TOKENS = 1 << 17
_FILE = (
    "shard int, segment int, first_token long, n_tokens long,"
    " doc_ids array<long>, doc_starts array<long>, codes binary"
)
_DOCS = "shard int, doc_id long, local long, n_tokens long, ids_crc32 long"


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Write ``docs`` (doc_id, text) as token files; ``end_id`` ends each document."""
    dealt = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    ).withColumn("tie", F.xxhash64("text"))
    ordered = dealt.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    end = np.array([end_id], dtype="<u4").tobytes()

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        shard = TaskContext.get().partitionId()
        made = first = 0
        ids, starts, raw, size = [], [], [], 0

        def close() -> pa.RecordBatch:
            codes = dac.encode(np.frombuffer(b"".join(raw), dtype="<u4"))
            row = [shard, made, first, size, ids, starts, codes]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            kinds += [pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            columns = [pa.array([x], kind) for x, kind in zip(row, kinds)]
            return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _FILE.split(", ")])

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                ids.append(doc_id.as_py())
                starts.append(size)
                raw.append(encode(text.as_py()) + end)
                size += len(raw[-1]) // 4
                if size >= SEGMENT_TOKENS:
                    yield close()
                    made, first = made + 1, first + size
                    ids, starts, raw, size = [], [], [], 0
        if ids:
            yield close()

    rows = in_arrow(ordered.select("doc_id", "text"), segments, _FILE)
    rows.write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32, as the files have them."""
    files = spark.read.parquet(path)

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                segment = dac.Segment(row["codes"])
                ends = [*row["doc_starts"][1:], segment.n]
                sums = [
                    zlib.crc32(segment.tokens(a, b).tobytes())
                    for a, b in zip(row["doc_starts"], ends)
                ]
                n = len(sums)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"]] * n, pa.int32()),
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array([row["first_token"] + a for a in row["doc_starts"]], pa.int64()),
                        pa.array([b - a for a, b in zip(row["doc_starts"], ends)], pa.int64()),
                        pa.array(sums, pa.int64()),
                    ],
                    ["shard", "doc_id", "local", "n_tokens", "ids_crc32"],
                )

    used = files.select("shard", "first_token", "doc_ids", "doc_starts", "codes")
    read = in_arrow(used, documents, _DOCS)
    before = F.sum("total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = (
        files.groupBy("shard")
        .agg(F.sum("n_tokens").alias("total"))
        .select("shard", F.coalesce(before, F.lit(0)).alias("before"))
    )
    return read.join(shards, "shard").select(
        "doc_id", (F.col("before") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_files(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write ``docs`` to fresh token files in the shared folder and read them back."""
    path = fresh_path(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer, end_id)
    return read_token_files(docs.sparkSession, path)
