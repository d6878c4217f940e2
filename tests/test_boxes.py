"""Nested boxes: the plain search's sums and distances, with few rows compared."""

import numpy as np
import pytest

from kmstream.functions.boxes import Boxes, box_order, chunks
from kmstream.functions.vectors import nearest_centers


def _case(n, d, ks, digits):
    rng = np.random.default_rng(n + d)
    X = rng.normal(size=(n, d)).round(digits)
    X, w = X[box_order(X)], rng.integers(1, 4, n).astype(np.float64)
    C = [X[rng.integers(0, n, k)] + 0.0 for k in ks]        # with equal centres, and ties where rows are rounded
    return X, w, C


@pytest.mark.parametrize("n, d, ks, digits", [(1000, 2, (1, 2, 5, 12), 1), (4096, 5, (1, 3, 100), 8), (1, 2, (1, 2), 1), (77, 33, (4, 7), 2), (300, 1, (40,), 0)])
def test_boxes_give_the_plain_searchs_sums_and_distances(n, d, ks, digits):
    X, w, C = _case(n, d, ks, digits)
    all_, first = np.concatenate(C), np.cumsum([0, *map(len, C)])
    box = Boxes(X, w)
    want = np.concatenate([np.column_stack([np.bincount(nearest_centers(X, c)[0], weights=w * v, minlength=len(c)) for v in (np.ones(n), *X.T)]) for c in C])
    assert np.allclose(box.assigned_sums(all_, first)[0], want)
    near, dist = np.full((len(C), n), -1), np.full((len(C), n), np.nan)
    for rows, cen, d2 in box.scored(all_, first):
        model, real = np.searchsorted(first, cen, side="right") - 1, rows < n
        assert (near[model[real], rows[real]] == -1).all()
        near[model[real], rows[real]], dist[model[real], rows[real]] = (cen - first[model])[real], d2[real]
    for m, c in enumerate(C):
        assert np.array_equal(near[m], nearest_centers(X, c)[0]) and np.array_equal(dist[m], nearest_centers(X, c)[1])


def test_order_is_a_permutation_and_most_rows_are_not_compared():
    rng = np.random.default_rng(1)
    X = rng.random((4000, 2))
    order = box_order(X)
    assert np.array_equal(np.sort(order), np.arange(4000))
    C = rng.random((20, 2))
    assert Boxes(X[order], np.ones(4000)).assigned_sums(C, np.array([0, 5, 20]))[1] < 0.4 * 8000


def test_chunks_cover_every_model_once():
    first = np.cumsum([0, 5, 20_000, 3, *[1] * 600])
    assert [m for a, b in chunks(first) for m in range(a, b)] == list(range(len(first) - 1))


def test_columns_that_do_not_vary_leave_few_rows_to_compare():
    """One-hot rows, many to a combination: one box set each, searched in the numbers alone."""
    from kmstream.functions import boxes
    rng = np.random.default_rng(5)
    X = np.concatenate([np.column_stack([rng.random((200, 2)), np.repeat(5.0 * np.eye(12)[[j]], 200, axis=0)]) for j in range(12)])
    X = np.concatenate([X[a:a + 200][box_order(X[a:a + 200])] for a in range(0, len(X), 200)])
    w = rng.integers(1, 4, len(X)).astype(np.float64)
    C = [X[rng.integers(0, len(X), k)] for k in (3, 30, 90)]
    C[1][4] = C[1][2]                                                 # equal centres: the lower one takes all
    all_, first = np.concatenate(C), np.cumsum([0, *map(len, C)])
    parts, total, searched = boxes.cut(X, w), np.zeros((len(all_), 15)), 0
    for box in parts:
        searched += box.add_sums(all_, first, total)
    want = np.concatenate([np.column_stack([np.bincount(nearest_centers(X, c)[0], weights=w * v, minlength=len(c)) for v in (np.ones(len(X)), *X.T)]) for c in C])
    assert len(parts) == 12 and np.allclose(total, want) and searched < 0.5 * len(X) * len(C)
    cost = sum((box.w[rows] * d2).sum() for box in parts for rows, _, d2 in box.scored(all_, first))
    assert cost == pytest.approx(sum((w * nearest_centers(X, c)[1]).sum() for c in C))


@pytest.mark.parametrize("pairs", [1, 40])
def test_boxes_tested_in_pieces_give_the_same(monkeypatch, pairs):
    from kmstream.functions import boxes
    X, w, C = _case(900, 3, (1, 4, 30), 1)
    all_, first = np.concatenate(C), np.cumsum([0, *map(len, C)])
    want, searched = Boxes(X, w).assigned_sums(all_, first)
    monkeypatch.setattr(boxes, "PAIRS", pairs)
    got, again = Boxes(X, w).assigned_sums(all_, first)
    assert np.array_equal(got, want) and again == searched
