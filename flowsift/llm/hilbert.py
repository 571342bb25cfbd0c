"""Hilbert keys of points, vectorised over rows."""

from __future__ import annotations

import numpy as np


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place along the Hilbert curve of each row of ``cells`` (n x d integers of ``bits`` bits).

    The curve is followed from the coarsest bit down: a coordinate whose bit is set flips the lower
    bits of the first coordinate, one whose bit is clear swaps them with it; the Gray code of what
    results, bits interleaved, is the key. d * bits must be below 64.
    """
    x = [c.astype(np.int64) for c in cells.T]
    d = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(d):
            on = (x[i] >> level) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(on, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
    for i in range(1, d):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[d - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    key = np.zeros_like(x[0])
    for level in range(bits - 1, -1, -1):
        for i in range(d):
            key = (key << 1) | (((x[i] ^ turn) >> level) & 1)
    return key


def to_cells(points: np.ndarray, mean: np.ndarray, spread: np.ndarray, bits: int, shift: np.ndarray | float = 0.0) -> np.ndarray:
    """Grid cells of points: standardised, shifted, and three standard deviations to each side."""
    z = (points - mean) / np.where(spread > 0, spread, 1.0)
    side = 1 << bits
    return np.clip(np.floor((z / 6.0 + 0.5 + shift) * side), 0, side - 1).astype(np.int64)
