"""Words of many texts as numpy arrays, with 64-bit hashes.

A word's hash is the sum of a random number of each byte times a random odd
number of its place: two different words agree with a chance of about 2^-63,
whatever they are.
"""

from __future__ import annotations

import numpy as np

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64 bits (the finisher of splitmix64)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def stream(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random numbers of 64 bits."""
    return mix((np.arange(1, n + 1, dtype=U) + U(seed << 40)) * U(0x9E3779B97F4A7C15))


BYTES = stream(256, 1)
_places = stream(256, 2) | U(1)


def places(n: int) -> np.ndarray:
    global _places
    if n > len(_places):
        _places = stream(max(n, 2 * len(_places)), 2) | U(1)
    return _places


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(members) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(members)] = True
    return found


def run_starts(member: np.ndarray, row_starts: np.ndarray) -> np.ndarray:
    """Where runs of members begin; no run reaches from one row to the next."""
    start = member.copy()
    start[1:] &= ~member[:-1]
    rows = row_starts[row_starts < len(member)]
    start[rows] = member[rows]
    return start


def piece_hashes(data: np.ndarray, inside: np.ndarray, start: np.ndarray) -> np.ndarray:
    """The hash of each piece. A piece begins at a `start` and has the `inside`
    bytes up to the next one."""
    at = np.flatnonzero(inside)
    first = np.flatnonzero(start[at])
    if not len(first):
        return np.zeros(0, U)
    length = np.diff(np.append(first, len(at)))
    place = np.arange(len(at)) - np.repeat(first, length)
    values = BYTES[data[at]] * places(int(length.max()))[place]
    return mix(np.add.reduceat(values, first))


def words(data: np.ndarray, offsets: np.ndarray, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of rows of bytes: their hashes, where they begin, and for each
    row the number of its first word (with one more entry at the end).
    `member` says which bytes belong to words."""
    inside = member[data]
    start = run_starts(inside, offsets[:-1])
    begin = np.flatnonzero(start)
    return piece_hashes(data, inside, start), begin, np.searchsorted(begin, offsets)
