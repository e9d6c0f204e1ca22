"""An open-addressing map from non-negative 62-bit integers to small ones, with numpy batches in and out."""

from __future__ import annotations

import numpy as np

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


class IntTable:
    """Linear probing over ``2**bits`` slots; the caller keeps it under half full."""

    def __init__(self, bits: int):
        self.bits, self.used = bits, 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.zeros(1 << bits, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * _SPREAD) >> np.uint64(64 - self.bits)).view(np.int64)

    def put(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Add distinct keys that are not there yet."""
        slots, last = self._slots(keys), (1 << self.bits) - 1
        self.used += len(keys)
        while len(keys):
            free = np.flatnonzero(self.keys[slots] < 0)
            self.keys[slots[free]] = keys[free]  # of several keys for one slot one stays
            mine = self.keys[slots] == keys
            self.values[slots[mine]] = values[mine]
            keys, values, slots = keys[~mine], values[~mine], (slots[~mine] + 1) & last

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The value of every key, -1 for those that are not there."""
        slots = self._slots(keys)
        met = self.keys[slots]
        out = np.where(met == keys, self.values[slots], np.int32(-1))
        open_ = np.flatnonzero((met != keys) & (met >= 0))
        last = (1 << self.bits) - 1
        while len(open_):
            at = slots[open_] = (slots[open_] + 1) & last
            met, wanted = self.keys[at], keys[open_]
            hit = met == wanted
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (met >= 0)]
        return out
