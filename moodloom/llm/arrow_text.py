"""Texts of an Arrow batch as one byte array."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and the n + 1 offsets into them; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, at
