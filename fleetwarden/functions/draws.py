"""Uniform numbers that follow from a key, for tasks that may run again."""

from __future__ import annotations

import numpy as np


def unit(key: np.ndarray, stream: int) -> np.ndarray:
    """A number in [0, 1) for each 64-bit key; another stream gives independent ones.

    Fixed constants: the finaliser of the public splitmix64 generator.
    """
    x = key.astype(np.int64).view(np.uint64) + np.uint64((stream + 1) * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(float) * 2.0**-53
