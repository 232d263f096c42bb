"""Whole texts on their way through a shuffle: packed, and only those that are wanted."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the filter that spares unwanted texts the shuffle; 1 MB however many are wanted.
FILTER_BITS = 1 << 23
_PER_BUCKET = 1 << 15  # of bitmap_construct_agg


def pack(column: pa.Array) -> pa.Array:
    """Each text by itself under zstd; null stays null."""
    engine = zstandard.ZstdCompressor(level=3, write_checksum=False)
    return pa.array([engine.compress(t.as_buffer()) if t.is_valid else None for t in column.cast(pa.binary())], pa.binary())


def unpack(column: pa.Array) -> pa.Array:
    engine = zstandard.ZstdDecompressor()
    return pa.array([None if t is None else engine.decompress(t) for t in column.to_pylist()], pa.binary()).cast(pa.string())


def parts(batches, *columns: int, limit: int = 256 << 10):
    """Slices of batches with at most ``limit`` bytes of packed text in ``columns``, or one row: a task holds little at once."""
    for batch in batches:
        size = np.cumsum([sum(len(x) if x is not None else 0 for x in row) for row in zip(*(batch.column(c).to_pylist() for c in columns))])
        first = 0
        while first < batch.num_rows:
            done = size[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(size, done + limit, "right")))
            yield batch.slice(first, last - first)
            first = last


def _pack(bits: np.ndarray | None):
    def run(batches):
        for batch in batches:
            if bits is not None:
                batch = passing(batch, bits, 2)
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                yield pa.RecordBatch.from_arrays([part.column(0), pack(part.column(1))], ["doc_id", "packed"])

    return run


def place(doc_id: str) -> Column:
    """Which bit of the filter an id has."""
    return F.pmod(F.xxhash64(doc_id), F.lit(FILTER_BITS))


def filter_bits(wanted: DataFrame) -> np.ndarray:
    """The filter of the ids of ``wanted`` (doc_id)."""
    # bitmap_bit_position counts from 0 where the value is 1.
    found = wanted.select((place("doc_id") + 1).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in found.collect():
        first = (row.bucket - 1) * _PER_BUCKET // 8
        bits[first : first + len(row.bits)] = np.frombuffer(bytes(row.bits), np.uint8)
    return bits


def passing(batch: pa.RecordBatch, bits: np.ndarray, column: int) -> pa.RecordBatch:
    """The rows whose bit, by the place in a column, is set."""
    at = batch.column(column).to_numpy()
    return batch.filter(pa.array((bits[at >> 3] >> (at & 7)) & 1 == 1))


def packed_texts(docs: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(doc_id, packed) of ``docs`` (doc_id, text); with ``wanted`` (doc_id) at least the rows of those ids, and few others.

    The filter has a fixed size: the more are wanted, the less it spares, but no wanted row is lost.
    """
    bits = None if wanted is None else filter_bits(wanted)
    source = docs.select("doc_id", F.col("text").cast("string"), place("doc_id").alias("place"))
    return source.mapInArrow(_pack(bits), "doc_id long, packed binary")
