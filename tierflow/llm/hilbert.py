"""The place of points along a Hilbert curve."""

from __future__ import annotations

import numpy as np


def curve_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``points`` (integers from 0 to 2**bits - 1, one
    column per dimension) along the curve through the grid; neighbours on the
    curve are neighbours in the grid. Columns times bits may be 63 at most.

    Each level of bits turns the cube it lies in (an exchange or a flip of the
    lower bits against the first axis); what is left is a Gray code.
    """
    x = points.astype(np.int64).T.copy()
    n = len(x)
    if n * bits > 63:
        raise ValueError("the key has 63 bits at most")
    for level in range(bits - 1, 0, -1):
        top, low = 1 << level, (1 << level) - 1
        for i in range(n):
            up = (x[i] & top) != 0
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    turn = np.zeros(points.shape[0], np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros(points.shape[0], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> level & 1)
    return key
