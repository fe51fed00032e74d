"""Packing without crossing: documents cut into pieces of power-of-two lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeflow.llm.packing import encode_texts

CAPACITY = 4096
END_ID = 2
#: Bits of a sequence number below the bucket: a task's number, then the sequence in it.
_TASK_BITS, _OWN_BITS = 24, 34


def binary_lengths(n: int, capacity: int) -> Iterator[int]:
    """Powers of two that sum to ``n``, falling: full sequences, then the binary digits of
    the rest."""
    for _ in range(n // capacity):
        yield capacity
    rest = n % capacity
    while rest:
        digit = 1 << (rest.bit_length() - 1)
        yield digit
        rest -= digit


def decomposed(
    docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens, bucket, sequence_id,
    offset`` and, ``with_ids``, ``ids``.

    Each document's ids and the end id are cut into powers of two of at most ``capacity``,
    itself a power of two.  A piece is a sequence of its own, so no sequence crosses documents
    or has padding; ``bucket`` is the exponent of its length.  Sequence numbers are unique,
    and ordered by them equal lengths lie together: bucket, task, place in the task.  A task
    that runs again replaces its rows as a whole.  No row moves to another task.

    NULL text counts as empty: one piece that holds the end id.  Repeated rows, NULL ids and
    ties are cut as they come; no rows, no pieces.
    """
    if capacity < 1 or capacity & (capacity - 1) or capacity >= 1 << 32:
        raise ValueError(f"the capacity must be a power of two below 2**32, not {capacity}")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    fields = [
        rows.schema["id"],
        *(T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")),
        T.StructField("bucket", T.IntegerType()),
        T.StructField("sequence_id", T.LongType()),
        T.StructField("offset", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        if task >> _TASK_BITS:
            raise ValueError(f"more than {1 << _TASK_BITS} tasks")
        made = 0
        end = np.array([end_id], dtype="<u4")
        for batch in batches:
            place, start, length, crc, whole, kept = [], [], [], [], [], []
            for k, ids in enumerate(encode_texts(path, batch.column("text").to_pylist())):
                ids, at = np.concatenate([ids, end]), 0
                data = memoryview(ids.tobytes())
                for n in binary_lengths(len(ids), capacity):
                    place.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(data[4 * at : 4 * (at + n)]))
                    whole.append(len(ids))
                    if with_ids:
                        kept.append(ids[at : at + n].astype(np.int32))
                    at += n
            size = np.array(length, dtype=np.int64)
            bucket = np.log2(np.maximum(size, 1)).astype(np.int64)
            own = np.arange(made, made + len(size))
            made += len(size)
            if made >> _OWN_BITS:
                raise ValueError(f"more than {1 << _OWN_BITS} sequences in a task")
            columns = [
                batch.column("id").take(pa.array(place, type=pa.int64())),
                *(pa.array(c, type=pa.int64()) for c in (start, size, crc, whole)),
                pa.array(bucket.astype(np.int32)),
                pa.array(bucket << (_TASK_BITS + _OWN_BITS) | task << _OWN_BITS | own, type=pa.int64()),
                pa.array(np.zeros(len(size), dtype=np.int64)),
            ]
            if with_ids:
                columns.append(pa.array(kept, type=pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return rows.mapInArrow(run, schema)


def write_buckets(pieces: DataFrame, folder: str) -> None:
    """The sequences of ``decomposed`` with their ids, a folder ``bucket=k`` for each length
    ``2**k``: a training step reads equal lengths and pads nothing."""
    pieces.write.partitionBy("bucket").parquet(folder)
