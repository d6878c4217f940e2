"""Rows in small tiles, compared with the centres in reach by single-precision products.

In five to eight columns boxes keep most of their centres, and plain products compare all.
A tile of ``TILE`` neighbouring rows leaves out the centres that are farther from its middle than
the nearest one by its diameter and compares the others, of several models at once, in one
product. The place of a centre takes the lowest bits of the distances, so that one minimum finds
both. Rows whose two nearest centres differ by less than rounding are compared again in double
precision, coordinates left to right and ties to the lowest id: the results are those of the plain search.
"""

from __future__ import annotations

import numpy as np

#: Rows of a tile, and numbers of one product.
TILE, PRODUCT = 256, 1 << 19


def nearest_in_tiles(rows: np.ndarray, C: np.ndarray, first: np.ndarray):
    """(first row, first model, centres) of ``rows`` in the order of ``boxes.box_order``: one line per model, a tile's rows side by side."""
    count = np.diff(first)
    model, start = np.repeat(np.arange(len(count)), count), np.asarray(first[:-1], np.int64)
    columns = [np.ascontiguousarray(C[:, i]) for i in range(C.shape[1])]
    for at in range(0, len(rows), TILE):
        X = rows[at:at + TILE]
        middle = (X.min(axis=0) + X.max(axis=0)) / 2
        near = X - middle
        x2 = np.einsum("ij,ij->i", near, near)
        far = np.zeros(len(C))
        for c, m in zip(columns, middle):
            gap = c - m
            gap *= gap
            far += gap
        reach = np.sqrt(np.minimum.reduceat(far, start)) + 2 * float(np.sqrt(x2.max()))
        kept = np.flatnonzero(far <= (reach * reach * (1 + 1e-9) + 1e-12 * float(far.max()))[model])
        many = np.bincount(model[kept], minlength=len(count))
        begin, right = np.cumsum(many) - many, np.vstack([near.T, np.ones(len(X)), x2]).astype(np.float32)
        a = 0
        while a < len(count):
            # models of a product: their lists are filled up to the longest one
            longest = np.maximum.accumulate(many[a:])
            b = a + max(1, int(np.searchsorted(longest * np.arange(1, len(longest) + 1) * len(X), PRODUCT, side="right")))
            yield at, a, _compared(X, right, C, columns, middle, far, kept, begin[a:b], many[a:b])
            a = b


def _compared(X, right, C, columns, middle, far, kept, begin, many):
    length, rows = int(many.max()), len(X)
    place = np.arange(length)
    there = place < many[:, None]
    ids = kept[np.where(there, begin[:, None] + place, begin[:, None])]
    left = np.empty((len(many), length, len(middle) + 2), np.float32)
    for i, (c, m) in enumerate(zip(columns, middle)):
        left[:, :, i] = -2.0 * (c[ids] - m)
    norm = far[ids]
    left[:, :, -2] = np.where(there, norm, 1e30)
    left[:, :, -1] = 1.0
    with np.errstate(all="ignore"):
        rough = (left.reshape(-1, left.shape[2]) @ right).reshape(len(many), length, rows).view(np.int32)
    bits = max(1, (length - 1).bit_length())
    mask = np.int32((1 << bits) - 1)
    rough &= ~mask
    rough |= place.astype(np.int32)[:, None]
    best = rough.min(axis=1)
    who = (best & mask).astype(np.int64)
    if length > 1:
        np.put_along_axis(rough, who[:, None, :], np.int32(0x7F000000), axis=1)
        low, next_ = (v.view(np.float32).astype(np.float64) for v in (best & ~mask, rough.min(axis=1) & ~mask))
        error = 8.0 * (len(middle) + 4) * 2.0 ** -24 * (norm.max(axis=1, where=there, initial=0.0)[:, None] + right[-1])
        unclear = ~((next_ - low > error + 2.0 ** (bits - 22) * np.abs(next_)) & (low < 1e29))
        g, t = np.nonzero(unclear)
        step = max(1, (PRODUCT >> 2) // length)
        for r in range(0, len(g), step):
            some, row = g[r:r + step], t[r:r + step]
            d2 = np.where(there[some], 0.0, np.inf)
            for i, c in enumerate(columns):
                gap = X[row, i, None] - c[ids[some]]
                d2 += gap * gap
            who[some, row] = d2.argmin(axis=1)
    return np.take_along_axis(ids, who, axis=1)
