"""Vector hashes of 64 bits."""

from __future__ import annotations

import numpy as np


def mix(keys: np.ndarray, seed: int = 0) -> np.ndarray:
    """A well-mixed 64-bit hash; different keys never agree for one seed."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
