"""Texts as arrays of code points."""

from __future__ import annotations

import functools

import numpy as np

POINTS = 0x110000


@functools.cache
def letters() -> np.ndarray:
    """Whether a code point is a letter (Unicode category L)."""
    return np.fromiter((chr(c).isalpha() for c in range(POINTS)), bool, POINTS)


@functools.cache
def folded() -> np.ndarray:
    """The lower case of letters and digits, a blank for all others."""
    out = np.full(POINTS, 32, np.uint32)
    for c in range(POINTS):
        if chr(c).isalnum():
            out[c] = ord(chr(c).lower()[0])
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def squeezed(points: np.ndarray) -> np.ndarray:
    """Which places stay when runs of blanks shrink to one."""
    blank = points == 32
    keep = np.ones(len(points), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    return keep
