"""Arrays of hashes packed by bucket, and bit tables of a fixed size.

A task sorts what it found by bucket (the leading bits of a hash) and emits one
row per bucket with the values as bytes, so a shuffle moves a few compact rows
instead of millions of small ones, and a bucket's work is vectorised.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame

from fundcast.llm import hashing

#: Bits of a filter: 8 MB, whatever the data. Beyond some 10 million keys it lets
#: more pass, which costs traffic but no results.
FILTER_BITS = 26


def bucket_bits(rows: int, bucket_rows: int = 1 << 20, most: int = 16) -> int:
    """Bits that give buckets of about ``bucket_rows`` rows."""
    return max(0, min(most, (max(rows, 1) // bucket_rows).bit_length()))


def bucket_of(key: np.ndarray, bits: int) -> np.ndarray:
    return (key >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)


def pack(bucket: np.ndarray, columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    """One row per bucket with every column's values as bytes."""
    if (bucket[1:] < bucket[:-1]).any():
        order = np.argsort(bucket.astype(np.uint16) if bucket.max() < 1 << 16 else bucket, kind="stable")
        bucket, columns = bucket[order], {c: x[order] for c, x in columns.items()}
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    starts = np.concatenate([[0], cuts]) if len(bucket) else cuts
    arrays = [pa.array(bucket[starts])]
    for x in columns.values():
        parts = np.split(x, cuts) if len(bucket) else []
        arrays.append(pa.array([p.tobytes() for p in parts], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", *columns])


def unpack(table: pa.Table, column: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(column).to_pylist()), kind)


def pair_order(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """An order by ``a``, then ``b``'s leading half, with equal pairs side by side (two
    quick sorts of one array each, where a sort by two keys takes several times as long)."""
    order = np.argsort(a)
    mine = a[order]
    code = np.zeros(len(a), np.uint64)
    np.cumsum(mine[1:] != mine[:-1], out=code[1:])
    code = code << np.uint64(32) | b[order] >> np.uint64(32)
    again = np.argsort(code)
    order, code = order[again], code[again]
    tie = np.flatnonzero(code[1:] == code[:-1])
    theirs = b[order]
    if (theirs[tie] != theirs[tie + 1]).any():  # halves that agree by chance
        return np.lexsort((b, a))
    return order


def gathered(batches: Iterator[pa.RecordBatch], rows: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Batches of narrow rows, joined to at least ``rows`` rows: packed by bucket they
    make few rows, however small the batches that Spark hands over."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= rows:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


@contextlib.contextmanager
def small_batches(spark, rows: int = 2000):
    """Within it, jobs hand texts to Python in batches of ``rows`` rows: the batches
    of whole documents that a task holds in and outside the JVM stay small."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Bits:
    """Bit table over hashes; a bucket owns one slice of it. Within a slice the last
    bits of the mixed hash count: the leading ones may have chosen the bucket."""

    def __init__(self, raw: np.ndarray, buckets: int):
        self.raw, self.low = raw, FILTER_BITS - buckets

    def has(self, bucket: np.ndarray, key: np.ndarray) -> np.ndarray:
        return self.has_mixed(bucket, hashing.mix(key))

    def has_mixed(self, bucket: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        """As ``has``, given the mixed keys."""
        slot = (bucket.astype(np.uint64) << np.uint64(self.low)) | (mixed & np.uint64((1 << self.low) - 1))
        return (self.raw[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 > 0


def slice_of(keys: np.ndarray, buckets: int) -> bytes:
    """The slice that a bucket with these keys has."""
    low = FILTER_BITS - buckets
    bits = np.zeros(1 << low, np.uint8)
    bits[(hashing.mix(keys) & np.uint64((1 << low) - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def assemble(rows, buckets: int) -> Bits:
    """A table from (bucket, bits) rows."""
    raw = np.zeros(1 << (FILTER_BITS - 3), np.uint8)
    size = len(raw) >> buckets
    for r in rows:
        raw[r.bucket * size : (r.bucket + 1) * size] = np.frombuffer(r.bits, np.uint8)
    return Bits(raw, buckets)


def bits_of(keys: DataFrame, column: str, buckets: int) -> Bits:
    """Bit table of a column of hashes, made in slices by bucket of the mixed hash."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches):
            key = np.unique(batch.column(column).to_numpy().view(np.uint64))
            yield pack(bucket_of(hashing.mix(key), buckets), {"keys": key})

    def slices(key: tuple, table: pa.Table) -> pa.Table:
        return pa.table({"bucket": [key[0].as_py()], "bits": [slice_of(unpack(table, "keys", np.uint64), buckets)]})

    made = keys.select(column).mapInArrow(emit, "bucket long, keys binary").groupBy("bucket").applyInArrow(
        slices, "bucket long, bits binary"
    )
    return assemble(made.collect(), buckets)  # 8 MB; a local iterator would run a job for every shuffle partition


def slices(batch: pa.RecordBatch, column: str, size: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in parts of at most about ``size`` bytes of the text column (a longer
    text is a part of its own), so that a task's arrays stay small."""
    lengths = np.array(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), np.int64)
    ends = np.cumsum(lengths)
    at = 0
    while at < batch.num_rows:
        start = ends[at] - lengths[at]
        to = max(at + 1, int(np.searchsorted(ends, start + size, "right")))
        yield batch.slice(at, to - at)
        at = to
