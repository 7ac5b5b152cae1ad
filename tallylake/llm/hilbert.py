"""Places on a Hilbert curve for whole batches of points."""

import numpy as np


def curve_keys(cells, bits):
    """Sortable keys (rows of bytes) of points with integer coordinates below 2**bits: their places on the curve.

    The transform of Skilling (2004): axis by axis, undo the reflections and swaps of every level, then Gray code. All
    points take each step together.
    """
    x = np.array(cells, dtype=np.uint32).T.copy()
    for level in range(bits - 1, 0, -1):
        low = np.uint32((1 << level) - 1)
        for axis in x:
            mirrored = (axis >> np.uint32(level)) & np.uint32(1) == 1
            swap = np.where(mirrored, np.uint32(0), (x[0] ^ axis) & low)
            axis ^= swap
            x[0] ^= np.where(mirrored, low, swap)
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turned = np.zeros(x.shape[1], np.uint32)
    for level in range(bits - 1, 0, -1):
        turned ^= np.where((x[-1] >> np.uint32(level)) & np.uint32(1) == 1, np.uint32((1 << level) - 1), np.uint32(0))
    x ^= turned
    planes = [(x >> np.uint32(level)) & np.uint32(1) for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)
