"""Optimal transport between compositions, each answer with a bound on its error."""

from __future__ import annotations

import numpy as np

#: Cells of plans held at once.
CELLS = 2_000_000


def _soft_min(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def _feasible(plan: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The plan changed a little so that its margins are ``a`` and ``b``."""
    plan = plan * np.minimum(1.0, a / np.maximum(plan.sum(2), 1e-300))[:, :, None]
    plan = plan * np.minimum(1.0, b / np.maximum(plan.sum(1), 1e-300))[:, None, :]
    rest_a, rest_b = np.maximum(a - plan.sum(2), 0.0), np.maximum(b - plan.sum(1), 0.0)
    return plan + rest_a[:, :, None] * rest_b[:, None, :] / np.maximum(rest_a.sum(1), 1e-300)[:, None, None]


def certified_transport(a: np.ndarray, b: np.ndarray, cost: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Costs of moving each row of ``a`` to that of ``b``, and by how much each can be above the optimum.

    Dual potentials are improved on the entropic problem, whose smoothing halves as soon
    as the margins fit.  A plan with the right margins costs at least the optimum, and
    potentials made feasible by a transform never more; a pair is done when the two are
    at most ``tolerance`` apart.  ``cost`` lies in [0, 1], rows sum to one.
    """
    price, gap = np.full(len(a), np.inf), np.full(len(a), np.inf)
    step = max(1, CELLS // max(cost.size, 1))
    for first in range(0, len(a), step):
        live = np.arange(first, min(first + step, len(a)))
        f, g, smooth = np.zeros((len(live), len(cost))), np.zeros((len(live), len(cost))), np.full(len(live), 0.1)
        while len(live):
            with np.errstate(divide="ignore"):
                log_a, log_b = np.log(a[live]), np.log(b[live])
            e, e_wide = smooth[:, None], smooth[:, None, None]
            for _ in range(10):
                f = -e * _soft_min((g[:, None, :] - cost) / e_wide + log_b[:, None, :], 2)
                g = -e * _soft_min((f[:, :, None] - cost) / e_wide + log_a[:, :, None], 1)
            plan = np.exp((f[:, :, None] + g[:, None, :] - cost) / e_wide + log_a[:, :, None] + log_b[:, None, :])
            misfit = np.abs(plan.sum(2) - a[live]).sum(1)
            upper = (_feasible(plan, a[live], b[live]) * cost).sum((1, 2))
            back = (cost - f[:, :, None]).min(axis=1)
            front = (cost - back[:, None, :]).min(axis=2)
            lower = (a[live] * front).sum(1) + (b[live] * back).sum(1)
            price[live], gap[live] = upper, np.maximum(upper - lower, 0.0)
            smooth = np.where(misfit <= tolerance, smooth / 2, smooth)
            open_ = gap[live] > tolerance
            live, f, g, smooth = live[open_], f[open_], g[open_], smooth[open_]
    return price, gap
