"""Minimum-cost matching under gates."""

from __future__ import annotations

import numpy as np


def cheapest_matching(cost: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of a matching of allowed pairs: as many pairs as can be, of least total cost among those.

    Each round adds one pair along the shortest path that alternates between unmatched and matched pairs, from any free
    row to any free column, so after every round the matching is the cheapest of its size. Distances are relaxed over
    whole arrays at once. Of equal paths the one to the first column, from the first row, is taken.
    """
    n, m = cost.shape
    price = np.where(allowed, cost, np.inf)
    row_of, col_of = np.full(m, -1), np.full(n, -1)
    for _ in range(min(n, m)):
        reach, came = np.where(col_of < 0, 0.0, np.inf), np.full(m, -1)
        far = np.full(m, np.inf)
        while True:
            through = reach[:, None] + price
            by = through.argmin(axis=0)
            best = through[by, np.arange(m)]
            better = best < far - 1e-12
            if not better.any():
                break
            far[better], came[better] = best[better], by[better]
            # A matched column hands its row on, with its pair taken back.
            held = np.flatnonzero(better & (row_of >= 0))
            reach[row_of[held]] = far[held] - price[row_of[held], held]
        ends = np.where(row_of < 0, far, np.inf)
        j = int(ends.argmin())
        if not np.isfinite(ends[j]):
            break
        while j >= 0:
            i = came[j]
            row_of[j], col_of[i], j = i, j, col_of[i]
    rows = np.flatnonzero(col_of >= 0)
    return rows, col_of[rows]
