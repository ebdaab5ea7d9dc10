"""Small helpers the operators share."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

#: A-Z to a-z on bytes; everything else stays.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Rows of an Arrow batch are taken in slices of about this many bytes of text.
SLICE_BYTES = 4 << 20


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the values of a text or binary column stay near ``limit`` bytes.

    A single longer value forms a slice of its own, so what a task holds as Python
    objects is bounded by the longest row, not by the rows of a batch.
    """
    import pyarrow.compute as pc

    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes, dtype=np.int64) // limit
        starts = np.flatnonzero(np.diff(part, prepend=-1))
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), batch.num_rows], strict=True):
            yield batch.slice(start, end - start)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    while name in df.columns:
        name = f"_{name}"
    return name


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers by byte planes, compressed."""
    top = int(values.max()) if len(values) else 0
    width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
    planes = values.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T.tobytes()
    return bytes([width]) + zlib.compress(planes, 1)


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(data[1:]), np.uint8).reshape(data[0], -1)
    return np.ascontiguousarray(planes.T).view(f"<u{data[0]}").ravel().astype(np.int64)


def pack_sorted(values: np.ndarray) -> bytes:
    return pack(np.diff(values, prepend=0))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data))


def summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in ascending order and the sum of each one's weights."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(weights[order], first) if len(first) else weights[:0]
