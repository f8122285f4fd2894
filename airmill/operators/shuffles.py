"""Pseudo-random numbers and permutations of row positions in plain integer arithmetic, so that any engine repeats them.

A permutation of 0..n-1 is a chain of rounds "swap or not": a round pairs every position x with (k - x) mod n, k a key of the round, and
a hash of the larger one of the pair decides whether both change places. Every round is its own inverse, so the chain is one-to-one for
any n, and one position is computed without the others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PRIME = 2_147_483_647
ROUNDS = 16


def _mix(u):
    """One step of the hash, on numbers or arrays; stays below 2**63."""
    v = (u * 48271 + 11) % PRIME
    return (v * v + v) % PRIME


def draw(*parts):
    """A number from 0 to PRIME - 1 for some whole numbers, each taken modulo PRIME."""
    out = 0
    for x in parts:
        out = _mix((out + x) % PRIME)
    return out


def round_keys(n: int, *stream: int) -> list[tuple[int, int]]:
    """Pairing key and hash key of every round."""
    return [((draw(*stream, r, 0) * PRIME + draw(*stream, r, 1)) % n, draw(*stream, r, 2)) for r in range(ROUNDS)]


def places(x: np.ndarray, n: int, *stream: int) -> np.ndarray:
    """Where a permutation of 0..n-1 sends the positions ``x``."""
    for k, c in round_keys(n, *stream):
        other = (k - x) % n
        high = np.maximum(x, other)
        x = np.where(draw(c, high % PRIME, high // PRIME) % 2 == 1, other, x)
    return x


def place(position: Column, n: int, *stream: int) -> Column:
    """``places`` of a position column, in Arrow batches."""

    @F.pandas_udf("long")
    def sent(x: pd.Series) -> pd.Series:
        return pd.Series(places(x.to_numpy(), n, *stream))

    return sent(position)
