"""Distance sums between two tiles of points, for use inside tasks."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle

# Workers receive these functions by value: the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUMS_SCHEMA = (
    "point long, weight double, sweep string, own long, cluster long, distance double, members double"
)
CHUNK_ROWS = 256


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of ``a`` to the rows of ``b``."""
    if a.shape[1] <= 8:
        square = np.zeros((len(a), len(b)))
        for d in range(a.shape[1]):
            square += (a[:, d, None] - b[None, :, d]) ** 2
    else:
        square = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
        np.maximum(square, 0.0, out=square)
    return np.sqrt(square, out=square)


def membership(labels: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The clusters present, and a rows x clusters matrix holding each row's weight."""
    present, at = np.unique(labels, return_inverse=True)
    matrix = np.zeros((len(labels), len(present)))
    matrix[np.arange(len(labels)), at] = weight
    return present, matrix


def towards(
    own: pd.DataFrame, other: pd.DataFrame, sweeps: Sequence[str], same: bool
) -> Iterator[pd.DataFrame]:
    """Per point of ``own``: summed distance to, and weight of, each cluster in ``other``."""
    a, b = np.stack(own["features"].to_numpy()), np.stack(other["features"].to_numpy())
    weight = other["weight"].to_numpy(float)
    clusters = [membership(other[s].to_numpy(), weight) for s in sweeps]
    joint = np.hstack([matrix for _, matrix in clusters])
    sums = np.empty((len(a), joint.shape[1]))
    for start in range(0, len(a), CHUNK_ROWS):
        block = distances(a[start : start + CHUNK_ROWS], b)
        if same:
            rows = np.arange(len(block))
            block[rows, rows + start] = 0.0
        sums[start : start + CHUNK_ROWS] = block @ joint
    column = 0
    for sweep, (present, matrix) in zip(sweeps, clusters):
        for cluster, size in zip(present, matrix.sum(0)):
            yield pd.DataFrame(
                {
                    "point": own["point"].to_numpy(),
                    "weight": own["weight"].to_numpy(),
                    "sweep": sweep,
                    "own": own[sweep].to_numpy(),
                    "cluster": cluster,
                    "distance": sums[:, column],
                    "members": size,
                }
            )
            column += 1


def tile_pair(lo: int, hi: int, rows: pd.DataFrame, sweeps: Sequence[str]) -> pd.DataFrame:
    """All distance sums between the points of two tiles, in both directions."""
    first, second = rows[rows["tile"] == lo], rows[rows["tile"] == hi]
    parts: list[pd.DataFrame] = []
    if len(first) and len(second):
        parts += towards(first, second, sweeps, lo == hi)
        if lo != hi:
            parts += towards(second, first, sweeps, False)
    if not parts:
        return pd.DataFrame(columns=[f.split()[0] for f in SUMS_SCHEMA.split(", ")])
    return pd.concat(parts)
