"""Least squares with a squared penalty on some coefficients and an absolute one on others."""

from __future__ import annotations

import numpy as np

#: Rounds of coordinate descent before the exact search.
SWEEPS = 60


def sparse_changes(gram: np.ndarray, xy: np.ndarray, ridge: np.ndarray, lasso: np.ndarray) -> np.ndarray:
    """For each of N systems, the ``b`` of least b'Gb - 2 b'xy + sum(ridge b^2) + sum(lasso |b|).

    What has no absolute penalty is eliminated first. Coordinate descent over all systems at
    once finds about which of the others are not zero; an active-set search then makes each
    system exact.
    """
    thin = lasso > 0
    full = gram + np.diag(ridge)
    if not thin.any():
        return np.linalg.solve(full, xy[..., None])[..., 0]
    rest = ~thin
    own, cross = full[:, rest][:, :, rest], full[:, rest][:, :, thin]
    half = lasso[thin] / 2
    solved = np.linalg.solve(own, np.concatenate([cross, xy[:, rest, None]], axis=2))
    a = full[:, thin][:, :, thin] - np.swapaxes(cross, 1, 2) @ solved[:, :, :-1]
    b = xy[:, thin] - np.einsum("nrh,nr->nh", cross, solved[:, :, -1])
    changes = _descent(a, b, half)
    for i in range(len(a)):
        changes[i] = _active_set(a[i], b[i], half, changes[i])
    out = np.zeros_like(xy)
    out[:, thin] = changes
    out[:, rest] = solved[:, :, -1] - np.einsum("nrh,nh->nr", solved[:, :, :-1], changes)
    return out


def _descent(a: np.ndarray, b: np.ndarray, half: np.ndarray) -> np.ndarray:
    x, slope = np.zeros_like(b), b.copy()
    size = np.maximum(np.einsum("nhh->nh", a), 1e-12)
    for _ in range(SWEEPS):
        most = 0.0
        for j in range(b.shape[1]):
            free = slope[:, j] + size[:, j] * x[:, j]
            step = np.sign(free) * np.maximum(np.abs(free) - half[j], 0) / size[:, j] - x[:, j]
            slope -= a[:, :, j] * step[:, None]
            x[:, j] += step
            most = max(most, float(np.abs(step).max(initial=0)))
        if most < 1e-10:
            break
    return x


def _active_set(a: np.ndarray, b: np.ndarray, half: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Solves for the coefficients that are not zero, drops the one that first changes its sign,
    takes in the one that gains most, until none does."""
    sign = np.sign(x)
    room = 1e-9 * max(float(np.abs(b).max(initial=0)), float(half.max()))
    for _ in range(20 * len(b) + 20):
        on = np.flatnonzero(sign)
        if len(on):
            wanted = np.linalg.solve(a[np.ix_(on, on)], b[on] - half[on] * sign[on])
            turned = wanted * sign[on] <= 0
            if turned.any():
                back = np.where(turned, x[on] / np.where(x[on] == wanted, 1, x[on] - wanted), np.inf)
                first = int(back.argmin())
                x[on] += back[first] * (wanted - x[on])
                x[on[first]] = sign[on[first]] = 0
                continue
            x[on] = wanted
        slope = b - a @ x
        gain = np.where(sign == 0, np.abs(slope) - half, -np.inf)
        best = int(gain.argmax())
        if gain[best] <= room:
            break
        sign[best] = np.sign(slope[best])
    return x
