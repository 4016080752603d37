"""Numbers packed into binary cells, so that many small rows travel through a shuffle as one.

The bytes of equal rank lie together: high bytes of small numbers are runs of zeros, which the codec
of a shuffle or a Parquet page removes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def pack(values: np.ndarray) -> bytes:
    size = values.dtype.itemsize
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), size).T).tobytes()


def unpack(cell: bytes, dtype: type) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(cell, np.uint8).reshape(size, len(cell) // size)
    return np.ascontiguousarray(planes.T).view(dtype).ravel()


def unpack_all(cells: pa.ChunkedArray | pa.Array, dtype: type) -> np.ndarray:
    found = [unpack(x.as_buffer() if hasattr(x, "as_buffer") else x, dtype) for x in cells]
    return np.concatenate(found) if found else np.zeros(0, dtype)
