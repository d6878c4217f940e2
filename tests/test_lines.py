"""Lines of rows and tiles: the plain search's sums, costs, distances and draws."""

import numpy as np
import pytest

from kmstream.functions import lines as lines_module
from kmstream.functions.boxes import Boxes, box_order, cut
from kmstream.functions.lines import Lines, on_lines
from kmstream.functions.vectors import nearest_centers
from kmstream.operators.restarts import _mix, _salts, content_hash, uniform, weighted_kmeans_pp


def _lines(n, d, values, digits):
    rng = np.random.default_rng(n + d + digits)
    X = rng.normal(size=(n, d)).round(digits)
    X[:, :d - 1] = rng.integers(0, values, (n, d - 1)) * 0.37
    X = np.unique(X, axis=0)
    return X, rng.integers(1, 4, len(X)).astype(np.float64), rng


def _plain(X, w, C):
    return np.concatenate([np.column_stack([np.bincount(nearest_centers(X, c)[0], weights=w * v, minlength=len(c)) for v in (np.ones(len(X)), *X.T)]) for c in C])


@pytest.mark.parametrize("n, d, values, digits, moved", [(3000, 2, 5, 2, 0.0), (3000, 2, 5, 8, 0.2), (5000, 4, 3, 3, 0.2), (5000, 4, 3, 2, 0.0), (64, 2, 1, 8, 0.0)])
def test_lines_give_the_plain_searchs_sums_costs_and_distances(n, d, values, digits, moved):
    X, w, rng = _lines(n, d, values, digits)
    C = [X[rng.integers(0, len(X), k)] + moved * rng.normal(size=(k, d)) for k in (1, 2, 5, 40, 90)]   # unmoved: equal centres and ties
    C.append(np.repeat(X[:1], 3, axis=0))
    all_, first = np.concatenate(C), np.cumsum([0, *map(len, C)])
    (box,) = cut(X, w)
    assert isinstance(box, Lines)
    total, want = box.assigned_sums(all_, first)[0], _plain(X, w, C)
    assert np.array_equal(total[:, 0], want[:, 0]) and np.allclose(total, want, atol=1e-9)
    assert np.allclose(box.costs(all_, first), [(w * nearest_centers(X, c)[1]).sum() for c in C], rtol=1e-9, atol=1e-12)
    near, dist = np.full((len(C), len(X)), -1), np.full((len(C), len(X)), np.nan)
    for rows, cen, d2 in box.scored(all_, first):
        model = np.searchsorted(first, cen, side="right") - 1
        assert (near[model, rows] == -1).all()
        near[model, rows], dist[model, rows] = cen - first[model], d2
    for m, c in enumerate(C):
        assert np.array_equal(near[m], nearest_centers(X, c)[0]) and np.array_equal(dist[m], nearest_centers(X, c)[1])


def test_draws_on_lines_are_those_of_every_row():
    X, w, rng = _lines(2000, 2, 4, 6)
    C = [X[rng.integers(0, len(X), k)] for k in (3, 20)]
    all_, first, chance, phi, seeds = np.concatenate(C), np.array([0, 3, 23]), np.array([200.0, 90.0]), np.array([1500.0, 40.0]), np.array([5, 6])
    model, rows = Lines(X, w, *on_lines(X)).drawn(all_, first, chance, phi, _salts(seeds, 1), content_hash(X), _mix)
    for m, c in enumerate(C):
        want = np.flatnonzero(uniform(content_hash(X), int(seeds[m]), 1) < chance[m] * w * nearest_centers(X, c)[1] / phi[m])
        assert len(want) and np.array_equal(np.sort(rows[model == m]), want)


def test_rows_on_no_lines_stay_in_boxes_and_long_lines_are_hardly_compared():
    rng = np.random.default_rng(2)
    assert on_lines(rng.random((500, 2))) is None and on_lines(np.array([[1.0, 2.0]])) is None
    assert on_lines(np.column_stack([np.zeros(100), np.arange(100.0)[::-1]])) is None      # not sorted
    X = np.column_stack([np.repeat([0.0, 1.0], 5000), np.tile(np.sort(rng.random(5000)), 2)])
    C = rng.random((300, 2))
    assert Lines(X, np.ones(len(X)), *on_lines(X)).assigned_sums(C, np.array([0, 100, 300]))[1] < 20


def test_a_line_is_searched_again_where_the_guess_is_too_small(monkeypatch):
    X, w, rng = _lines(3000, 2, 5, 8)
    C = [X[rng.integers(0, len(X), k)] for k in (7, 60)]
    all_, first = np.concatenate(C), np.array([0, 7, 67])
    want = Lines(X, w, *on_lines(X)).assigned_sums(all_, first)[0]
    made = lines_module.ByLine.__init__

    def small(self, *args):
        made(self, *args)
        self.cell = self.cell * 1e-9

    monkeypatch.setattr(lines_module.ByLine, "__init__", small)
    assert np.allclose(Lines(X, w, *on_lines(X)).assigned_sums(all_, first)[0], want, atol=1e-9)


@pytest.mark.parametrize("n, d, ks, digits", [(1000, 5, (1, 70, 150), 1), (3000, 6, (3, 100, 257), 8), (300, 8, (200,), 0)])
def test_tiles_give_the_plain_searchs_sums(n, d, ks, digits, monkeypatch):
    rng = np.random.default_rng(n)
    X = rng.normal(size=(n, d)).round(digits)
    X, w = X[box_order(X)], rng.integers(1, 4, n).astype(np.float64)
    C = [X[rng.integers(0, n, k)] for k in ks]
    used = []
    plain = Boxes._add_tiled
    monkeypatch.setattr(Boxes, "_add_tiled", lambda self, *a: (used.append(1), plain(self, *a))[1])
    total, _ = Boxes(X, w).assigned_sums(np.concatenate(C), np.cumsum([0, *map(len, C)]))
    want = _plain(X, w, C)
    assert used and np.array_equal(total[:, 0], want[:, 0]) and np.allclose(total, want)


def test_candidates_are_reduced_alike_in_boxes_and_by_the_plain_search(monkeypatch):
    from kmstream.operators import restarts
    rng = np.random.default_rng(9)
    C, w = rng.normal(size=(240, 2)), rng.integers(0, 9, 240).astype(np.float64)
    one = weighted_kmeans_pp(C, w, 60, 3)
    monkeypatch.setattr(restarts, "BOXED", 2)
    assert np.allclose(weighted_kmeans_pp(C, w, 60, 3), one, rtol=0, atol=1e-9)
    # the draws of numpy's choice
    rng, p = np.random.default_rng(3), np.where(w > 0, w, 1e-12)
    first = C[rng.choice(len(C), p=p / p.sum())]
    assert np.array_equal(weighted_kmeans_pp(C, w, 1, 3, iters=0), [first])


def test_wide_passes_hold_few_numbers():
    from kmstream.operators.blocks import NUMBERS
    from kmstream.operators.restarts import _passes
    specs = {(k, r): (k, r) for k in range(2, 245) for r in range(10)}
    parts = _passes(specs, NUMBERS // 178)
    assert [key for part in parts for key in part] == list(specs)
    assert all(178 * sum(k for k, _ in part.values()) <= NUMBERS for part in parts)
