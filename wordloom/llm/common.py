"""What the operators of this package share: picking columns, folds, packed arrays, text slices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 4 << 20


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, found by exact name and place, so that others with like names do no harm."""
    places = [df.columns.index(name) for name in names]
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return plain.select(*[F.col(f"c{place}").alias(name) for place, name in zip(places, names, strict=True)])


def fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def pack(values: np.ndarray) -> bytes:
    """Compressed bytes of an array."""
    return zstandard.compress(np.ascontiguousarray(values).tobytes(), 1)


def unpack(data: bytes, dtype) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(data), dtype)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as compressed byte planes of their steps."""
    steps = np.diff(keys, prepend=np.int64(0))
    return pack(steps.view(np.uint8).reshape(-1, 8).T)


def unpack_sorted(data: bytes) -> np.ndarray:
    planes = unpack(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.int64).ravel())


def text_slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null gives empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def as_texts(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def plain_names(df: DataFrame, **known: str) -> DataFrame:
    """The frame with its columns named by place, but for the ``known`` ones: new name = old name."""
    places = {df.columns.index(old): new for new, old in known.items()}
    return df.toDF(*[places.get(i, f"c{i}") for i in range(len(df.columns))])


def sent_whole(small: DataFrame, most_rows: int = 1_000_000) -> DataFrame:
    """Marked for broadcast if it is counted to have at most so many rows; else left to a shuffled join."""
    return F.broadcast(small) if small.limit(most_rows + 1).count() <= most_rows else small
