"""A mergeable sketch of weighted items, on numpy arrays.

It is a Misra-Gries summary with weights: when more items than its capacity are held,
the largest weight that does not fit is taken from all of them. What an item lost that
way is at most ``lost``, and all losses of summaries that are merged together stay under
their total weight divided by the capacity. An item whose weight reaches 1 is settled:
it stays whatever follows and takes no more weight. These helpers run in Spark tasks.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Sums of weights are rounded; an item this close to 1 counts as having reached it.
SLIP = 1e-6


class WeightSketch:
    def __init__(self, capacity: int) -> None:
        self.capacity, self.lost = capacity, 0.0
        self.codes, self.weights = np.zeros(0, np.uint64), np.zeros(0)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._size = 0

    def add(self, codes: np.ndarray, weights: np.ndarray, lost: float = 0.0) -> None:
        """Take in items, or another sketch with what it lost."""
        self._waiting.append((codes, weights))
        self._size += len(codes)
        self.lost += lost
        if self._size >= self.capacity:
            self.settle()

    def settle(self) -> None:
        if not self._size:
            return
        codes, weights = map(np.concatenate, zip((self.codes, self.weights), *self._waiting))
        self._waiting, self._size = [], 0
        self.codes, place = np.unique(codes, return_inverse=True)
        self.weights = np.bincount(place, weights, len(self.codes))
        self.weights[self.weights >= 1.0 - SLIP] = np.inf
        loose = self.weights[np.isfinite(self.weights)]
        if len(loose) > self.capacity:
            rank = len(loose) - self.capacity - 1
            cut = float(np.partition(loose, rank)[rank])
            self.weights -= cut
            self.lost += cut
            held = self.weights > 0
            self.codes, self.weights = self.codes[held], self.weights[held]

    def reaching(self) -> np.ndarray:
        """The items that may have a weight of 1; all that do are among them."""
        self.settle()
        return self.codes[self.weights + self.lost >= 1.0 - SLIP]


def pack(codes: np.ndarray, weights: np.ndarray) -> bytes:
    return codes.tobytes() + weights.tobytes()


def unpack(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    half = len(data) // 2
    return np.frombuffer(data[:half], np.uint64), np.frombuffer(data[half:])
