"""Row numbers of known keys, for whole arrays."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class KeyTable:
    """Distinct unsigned keys by open addressing."""

    keys: np.ndarray
    bits: int = 0
    slots: np.ndarray = field(default=None, repr=False)

    def __post_init__(self) -> None:
        self.bits = max(4, int(np.ceil(np.log2(max(len(self.keys), 1) * 4))))
        self.slots = np.full(1 << self.bits, -1, dtype=np.int32)
        left = np.arange(len(self.keys))
        at = self._home(self.keys)
        while len(left):
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]  # the last of those that share a slot gets it
            placed = self.slots[at] == left
            left, at = left[~placed], (at[~placed] + 1) & (len(self.slots) - 1)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        spread = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each key, -1 where it is unknown."""
        at = self._home(keys)
        found = self.slots[at]
        if not len(self.keys):
            return found
        open_ = np.flatnonzero((found >= 0) & (self.keys[found] != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) & (len(self.slots) - 1)
            found[open_] = self.slots[at[open_]]
            open_ = open_[(found[open_] >= 0) & (self.keys[found[open_]] != keys[open_])]
        return found
