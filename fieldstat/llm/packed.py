"""Integer arrays as compressed bytes: differences by byte planes, then zstd."""

from __future__ import annotations

import numpy as np
import zstandard


def pack(values: np.ndarray) -> bytes:
    """Bytes of non-negative integers in any order; ascending ones take least room."""
    steps = np.diff(np.asarray(values).astype(np.uint64), prepend=np.uint64(0))
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T))


def unpack(code: bytes) -> np.ndarray:
    """The integers, as unsigned 64-bit ones."""
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(code), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).reshape(-1).view(np.uint64), dtype=np.uint64)


def pack_unordered(values: np.ndarray) -> bytes:
    """Bytes of integers from 0 to 2**32 - 1 that have no order: by byte planes, without differences."""
    planes = np.ascontiguousarray(np.asarray(values).astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def unpack_unordered(code: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(code), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view("<u4")
