"""Keys of documents, and blobs that carry many small numbers through one shuffle row."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NO_ID = -(2**63)


def with_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(did, k1, doc_id, text) with no nulls in did, k1 and text.

    k1 hashes id and text, so rows that share an id but not a text keep apart, and rows that repeat both are
    one document whose result every such row gets. A null id sorts before all others; a null text is empty.
    Other columns of the input are left aside, whatever their names.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    ident = F.col(id_col).cast("long")
    return docs.select(
        F.coalesce(ident, F.lit(NO_ID)).alias("did"), F.xxhash64(ident, text).alias("k1"), ident.alias("doc_id"), text.alias("text")
    )


def total_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """Bytes of text in the table: what sizes of buckets follow."""
    return int(docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0])


def bucket_bits(n_bytes: int, per_bucket: int) -> int:
    """Bits of a bucket's number, so that a bucket stands for about ``per_bucket`` bytes of text; 64 buckets at least."""
    return max(6, math.ceil(math.log2(max(1, n_bytes) / per_bucket)))


def task_part(n: int) -> int:
    """A number for the n-th flush of this task, the same in every attempt."""
    return (TaskContext.get().partitionId() << 24) + n


def settled(n: int, part: int) -> list[int]:
    """The group number, below zero, of rows that a map batch has settled itself: each batch has a group of its own, so
    there are more of them, not larger ones, as the corpus grows."""
    return [-1 - part] * n


def pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    """Arrays of one length as one compressed blob, byte plane by byte plane."""
    n = len(arrays[0])
    head = np.array([n, *(ord(a.dtype.char) for a in arrays)], dtype=np.int64)
    planes = [np.ascontiguousarray(a.view(np.uint8).reshape(n, a.itemsize).T).tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=level).compress(np.int64(len(head)).tobytes() + head.tobytes() + b"".join(planes))


def unpack(blob: bytes) -> list[np.ndarray]:
    """The arrays of ``pack``."""
    raw = zstandard.ZstdDecompressor().decompress(blob)
    k = int(np.frombuffer(raw, np.int64, 1)[0])
    head = np.frombuffer(raw, np.int64, k, 8)
    n, at, out = int(head[0]), 8 + 8 * k, []
    for c in head[1:]:
        kind = np.dtype(chr(c))
        size = n * kind.itemsize
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, size, at).reshape(kind.itemsize, n).T).view(kind).reshape(n))
        at += size
    return out


def deltas(x: np.ndarray) -> np.ndarray:
    """Differences of a sorted array, the first against 0; ``np.cumsum`` with its dtype undoes it."""
    return np.diff(x, prepend=x.dtype.type(0))


_KINDS = {pa.int16(): "short", pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string", pa.bool_(): "boolean", pa.float64(): "double"}


def ddl(schema: pa.Schema) -> str:
    """The Spark schema of an Arrow schema."""
    return ", ".join(f"{f.name} {_KINDS[f.type]}" for f in schema)


def by_group(df: DataFrame, key: str, function: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: pa.Schema) -> DataFrame:
    """Applies a function of batches to the rows of each key."""

    def whole(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches(list(function(table.to_batches())), schema=schema)

    return df.groupBy(key).applyInArrow(whole, ddl(schema))
