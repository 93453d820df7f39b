"""The unmixing solver: mixtures of tables that are not monotone, held against what was mixed, dense grids and a closing lattice."""

import numpy as np
import pytest

from nivalis.operators import lut, unmix

AXES = [np.linspace(0, 1, 5), np.linspace(30**0.5, 1200**0.5, 30), np.linspace(0, 1e-3, 6)]


def waves():
    """Bands that rise and fall with grain size and dust, so that there are several valleys."""
    rng = np.random.default_rng(0)
    mu, g, d = np.meshgrid(*AXES, indexing="ij")
    return np.stack([50 + 30 * np.sin(g * rng.uniform(0.2, 0.8) + rng.uniform(0, 6) + 3e3 * d * rng.uniform(0.3, 1.5)) + 2 * mu for _ in range(7)], -1)


def mixtures(table, n, noise, seed=2):
    rng = np.random.default_rng(seed)
    g, d, mu = rng.uniform(*unmix.GRAIN, n), rng.uniform(*unmix.DUST, n), rng.uniform(0.1, 0.95, n)
    f = rng.uniform(0.2, 1, n)
    s, ground = rng.uniform(0, 1, n) * (1 - f), rng.uniform(3, 60, (n, 7))
    r = f[:, None] * lut.interpolate(AXES, table, np.stack([mu, g, d], 1)) + (1 - f - s)[:, None] * ground
    return r + rng.normal(0, 1, (n, 7)) * noise, ground, mu, (f, s, g, d)


def lattice(r, ground, mu, table, solve, nodes=unmix.GRID, rounds=9):
    """Squared residuals of a grid that closes in on its best place."""
    lo, hi = np.array([unmix.GRAIN[0], unmix.DUST[0]]), np.array([unmix.GRAIN[1], unmix.DUST[1]])
    size, n = (hi - lo) / (np.array(nodes) - 1), len(r)
    tries = [np.tile(lo + size * (i, j), (n, 1)) for i in range(nodes[0]) for j in range(nodes[1])]
    at, best = tries[0], np.full(n, np.inf)
    for _ in range(rounds + 1):
        for there in tries:
            e = solve(r, lut.interpolate(AXES, table, np.column_stack([mu, np.clip(there, lo, hi)])), ground)[2]
            at, best = np.where((e < best)[:, None], there, at), np.minimum(e, best)
        size = size / 2
        tries = [np.clip(at + size * (i, j), lo, hi) for i in (-1, 0, 1) for j in (-1, 0, 1)]
    return best


@pytest.mark.parametrize("solve", [unmix.fractions, unmix.mixed_only])
@pytest.mark.parametrize("noise", [0, 2])
def test_residual_is_never_above_the_lattices(solve, noise):
    table = waves()
    r, ground, mu, _ = mixtures(table, 400, noise)
    found = np.sqrt(unmix.search(r, ground, mu, AXES, table, solve)[4])
    plain = np.sqrt(lattice(r, ground, mu, table, solve))
    assert (found <= plain + 1e-6).all() and (found < plain - 0.01).mean() > 0.5


def test_mixtures_without_noise_are_explained():
    """Nearly all to the last digit, and where the place is not that which was mixed, its residual is that of the result."""
    table = waves()
    r, ground, mu, truth = mixtures(table, 400, 0)
    f, s, g, d, e = unmix.search(r, ground, mu, AXES, table)
    assert (np.sqrt(e) < 0.05).mean() > 0.95
    right = (np.abs(f - truth[0]) < 0.01) & (np.abs(g - truth[2]) < 0.2)
    assert right.mean() > 0.85
    model = f[:, None] * lut.interpolate(AXES, table, np.stack([mu, g, d], 1)) + (1 - f - s)[:, None] * ground
    assert np.allclose(((r - model) ** 2).sum(1), e)
    assert (f >= 0).all() and (s >= 0).all() and (f + s <= 1 + 1e-12).all()


def test_residual_is_near_the_best_of_a_dense_grid():
    table = waves()
    r, ground, mu, _ = mixtures(table, 40, 2, seed=7)
    found = np.sqrt(unmix.search(r, ground, mu, AXES, table)[4])
    dense = np.sqrt(lattice(r, ground, mu, table, unmix.fractions, (150, 60), 0))
    assert (found <= dense + 0.02).mean() > 0.9 and found.mean() < dense.mean() + 0.05


def test_slopes_are_differences_within_a_cell():
    table, rng = waves(), np.random.default_rng(4)
    at = np.column_stack([rng.uniform(a[0], a[-1], 50) for a in AXES])
    value, along_grain, along_dust = lut.interpolate_with_slopes(AXES, table, at, [1, 2])
    assert np.allclose(value, lut.interpolate(AXES, table, at))
    for axis, slope, h in ((1, along_grain, 1e-6), (2, along_dust, 1e-10)):
        there = at.copy()
        there[:, axis] += h
        inside = np.searchsorted(AXES[axis], there[:, axis]) == np.searchsorted(AXES[axis], at[:, axis])
        assert inside.any() and np.allclose(((lut.interpolate(AXES, table, there) - value) / h)[inside], slope[inside], rtol=1e-3, atol=1e-3 / h * 1e-6)
