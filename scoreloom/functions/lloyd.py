"""The kernel of a K-means round: nearest centres and sums for many sets of centres at once."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np

# Points whose distances to all centres are held at a time.
_BLOCK = 1024


def centre_sums(batches: Iterable[tuple[np.ndarray, np.ndarray]], centres: Sequence[np.ndarray]) -> dict[str, list]:
    """Per set and cluster: the weight of its points, their weighted squared distances and coordinate sums.

    ``batches`` are pairs of points (rows) and weights. Of equally near centres
    the first counts. Columns are ``fit, cluster, weight, cost, s0, s1, ...``.
    """
    width = centres[0].shape[1]
    sizes = np.array([len(c) for c in centres])
    # Sets of one size lie together, cluster by cluster: (clusters, sets) rows each.
    groups = [(int(k), np.flatnonzero(sizes == k)) for k in np.unique(sizes)]
    stacked = [np.stack([centres[i] for i in sets], axis=1).reshape(-1, width) for _, sets in groups]
    totals = [np.zeros((len(c), width + 2)) for c in stacked]
    lengths = [(c * c).sum(axis=1)[:, None] for c in stacked]
    for x, w in batches:
        for at in range(0, len(x), _BLOCK):
            p, v = x[at : at + _BLOCK], w[at : at + _BLOCK]
            weighted = np.column_stack([v, p * v[:, None]])
            norms = (p * p).sum(axis=1)
            for (k, sets), c, length, total in zip(groups, stacked, lengths, totals):
                far = (length - 2 * (c @ p.T)).reshape(k, len(sets), -1)
                near = far.min(axis=0)
                free = np.ones(near.shape, dtype=bool)
                cost = np.maximum(near + norms, 0) * v
                for j in range(k):
                    own = free & (far[j] == near)
                    free &= ~own
                    mine = own.astype(float)
                    rows = slice(j * len(sets), (j + 1) * len(sets))
                    total[rows, 1:] += mine @ weighted
                    total[rows, 0] += (mine * cost).sum(axis=1)
    fits = [(i, j) for k, sets in groups for j in range(k) for i in sets]
    table = np.concatenate(totals)
    return {
        "fit": np.array([i for i, _ in fits], dtype=np.int32),
        "cluster": np.array([j for _, j in fits], dtype=np.int32),
        "weight": table[:, 1],
        "cost": table[:, 0],
        **{f"s{i}": table[:, i + 2] for i in range(width)},
    }
