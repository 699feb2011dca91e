"""Sorted 64-bit keys and small counts as compact binary cells, so that a shuffled row carries thousands of them."""

from __future__ import annotations

import numpy as np


def pack_counts(counts: np.ndarray) -> bytes:
    """Non-negative integers as a byte each, and those from 255 on in full behind: most n-grams are rare."""
    large = counts[counts >= 255].astype("<u8")
    return len(large).to_bytes(4, "little") + large.tobytes() + np.minimum(counts, 255).astype(np.uint8).tobytes()


def unpack_counts(cell: bytes) -> np.ndarray:
    n = int.from_bytes(cell[:4], "little")
    counts = np.frombuffer(cell, np.uint8, offset=4 + 8 * n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(cell, "<u8", count=n, offset=4).astype(np.int64)
    return counts


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending uint64 keys as differences of as few bytes as the largest needs; the first byte names the width."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u8")
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(keys) else 1
    return bytes([width]) + steps.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_keys(cell: bytes) -> np.ndarray:
    width = cell[0]
    packed = np.frombuffer(cell, np.uint8, offset=1).reshape(-1, width)
    steps = np.zeros((len(packed), 8), np.uint8)
    steps[:, :width] = packed
    return np.cumsum(steps.view("<u8").ravel(), dtype=np.uint64)
