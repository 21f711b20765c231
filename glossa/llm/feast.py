"""Eigenpairs of a symmetric matrix inside an interval by contour integration (FEAST).

The matrix is dense, symmetric and as wide as a vector has dimensions, so it fits the
driver whatever the number of rows it was summed from. No rows are handled here.
"""

from __future__ import annotations

import numpy as np

POINTS = 12           # quadrature points on the upper half of the contour
ROUNDS = 200          # subspace iterations before a failure is reported


def inertia_above(a: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of ``a`` above ``shift``: the positive pivots of ``a - shift I``
    (Sylvester's law), by symmetric elimination with complete pivoting on 1 x 1 and 2 x 2 blocks."""
    m = a - shift * np.eye(len(a))
    positive = 0
    while len(m):
        diagonal = np.abs(np.diag(m))
        p = int(diagonal.argmax())
        off = np.abs(m - np.diag(np.diag(m)))
        r, s = np.unravel_index(int(off.argmax()), off.shape)
        if max(diagonal[p], off[r, s]) == 0:
            return positive
        if diagonal[p] >= 0.64 * off[r, s]:
            positive += bool(m[p, p] > 0)
            block = [p]
        else:                                   # a 2 x 2 block with a dominant off-diagonal: one pivot of each sign
            positive += 1
            block = [int(r), int(s)]
        rest = np.setdiff1d(np.arange(len(m)), block)
        cross = m[np.ix_(rest, block)]
        m = m[np.ix_(rest, rest)] - cross @ np.linalg.solve(m[np.ix_(block, block)], cross.T)
        m = (m + m.T) / 2
    return positive


def _shift_below(a: np.ndarray, wanted: int, low: float, high: float, near: float) -> float:
    """A shift with at least ``wanted`` eigenvalues above it, less than ``near`` below the last of them."""
    while high - low > near:
        middle = (low + high) / 2
        if inertia_above(a, middle) >= wanted:
            low = middle
        else:
            high = middle
    return low


def top_components(cov: np.ndarray, wanted: int, negligible: float = 1e-12):
    """``(eigenvalues, vectors)`` of the ``wanted`` largest eigenvalues, falling; a vector is a row.

    Eigenvalues at or below ``negligible`` times the trace count as zero and are left out.
    1. Bisection on inertia counts gives an interval that begins just below the wanted eigenvalues
       and says how many it holds. 2. A circle around it is the contour: the trapezoidal rule over complex
       shifted solves projects a subspace onto its eigenvectors, Rayleigh-Ritz turns that into
       eigenpairs, and the subspace is filtered again until the residuals are at rounding level.
    3. The pairs found inside must be as many as the inertia count; a pair missed raises.
    """
    a = (cov + cov.T) / 2
    d = len(a)
    trace = float(np.trace(a)) if d else 0.0
    wanted = min(wanted, d)
    if not trace > 0 or not wanted:
        return np.zeros(0), np.zeros((0, d))
    a = a / trace                                                   # eigenvalues in [0, 1]
    wanted = min(wanted, inertia_above(a, negligible))
    bound = min(1.0, float(np.abs(a).sum(axis=1).max())) * (1 + 1e-9)
    first = _shift_below(a, 1, 0.0, bound, 1e-3 / d)
    high = min(bound, first + 2e-3 / d)                             # no eigenvalue above it
    low = max(_shift_below(a, wanted, 0.0, high, 1e-3 / d), negligible)
    inside = inertia_above(a, low)
    size = min(d, max(4 * inside, inside + 12))
    centre, radius = (low + high) / 2, (high - low) / 2
    angles = np.pi * (np.arange(POINTS) + 0.5) / POINTS
    nodes = centre + radius * np.exp(1j * angles)
    weights = radius * np.exp(1j * angles) / POINTS
    space = np.linalg.qr(np.random.default_rng(13).standard_normal((d, size)))[0]
    eye = np.eye(d)
    for _ in range(ROUNDS):
        filtered = sum((w * np.linalg.solve(z * eye - a, space)).real for z, w in zip(nodes, weights))
        basis = np.linalg.qr(filtered)[0]
        values, small = np.linalg.eigh(basis.T @ a @ basis)
        space = basis @ small
        found = np.flatnonzero((values > low) & (values <= high))
        residual = np.abs(a @ space[:, found] - space[:, found] * values[found]).max(initial=0.0) / max(values[-1], negligible)
        if len(found) == inside and residual < 4e-15:
            break
    else:
        if len(found) != inside or residual > 1e-11:
            raise ArithmeticError(f"{len(found)} of {inside} eigenpairs found, residual {residual}")
    order = found[np.argsort(-values[found], kind="stable")][:wanted]
    vectors = space[:, order].T
    return values[order] * trace, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
