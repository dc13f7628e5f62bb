"""Golomb-Rice codes of sorted integers, vectorised.

The quotients (unary) and the remainders (fixed width) are kept as two bit
streams, so both directions are array operations without a loop over codes.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QBQ")


def encode(values: np.ndarray, universe: int) -> bytes:
    """``values``: ascending unsigned integers below ``universe``."""
    n = len(values)
    if n == 0:
        return _HEAD.pack(0, 0, 0)
    width = max(0, (max(1, universe // n)).bit_length() - 1)
    gaps = np.diff(values.astype(np.uint64), prepend=np.uint64(0))
    quotients = (gaps >> np.uint64(width)).astype(np.int64)
    unary = np.ones(int(quotients.sum()) + n, np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 0
    shifts = np.arange(width, dtype=np.uint64)
    rest = ((gaps[:, None] >> shifts) & np.uint64(1)).astype(np.uint8).ravel()
    ones = np.packbits(unary).tobytes()
    return _HEAD.pack(n, width, len(ones)) + ones + np.packbits(rest).tobytes()


def decode(code: bytes) -> np.ndarray:
    n, width, size = _HEAD.unpack_from(code)
    if n == 0:
        return np.empty(0, np.uint64)
    at = _HEAD.size
    unary = np.unpackbits(np.frombuffer(code, np.uint8, size, at))
    ends = np.flatnonzero(unary == 0)[:n]
    quotients = np.diff(ends, prepend=-1) - 1
    gaps = quotients.astype(np.uint64) << np.uint64(width)
    if width:
        bits = np.unpackbits(np.frombuffer(code, np.uint8, -1, at + size), count=n * width)
        weights = np.uint64(1) << np.arange(width, dtype=np.uint64)
        gaps += bits.reshape(n, width).astype(np.uint64) @ weights
    return np.cumsum(gaps, dtype=np.uint64)
