"""Packed shuffles: hashed records cross the network as sorted byte blocks, one per map block and slot.

A map block is a run of consecutive rows of a partition. Its records are cut by the top bits of their hashes into
slots; each slot's records are one binary cell. Equal hashes meet in one slot. Where a hash has many records in a
block, the caller sends one for all of them, so a hash that stands everywhere costs one record per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def slot_of(h: np.ndarray, slots: int) -> np.ndarray:
    """The slot of each 64-bit hash, in order of hash: equal shares of the hash range."""
    return ((h >> np.uint64(32)) * np.uint64(slots)) >> np.uint64(32)


def cut_arrays(h: np.ndarray, records: np.ndarray, slots: int) -> Iterator[tuple[int, np.ndarray]]:
    """(slot, its records) of records that are in order of their hashes `h`."""
    of = slot_of(h, slots)
    edges = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1]))) if len(of) else np.zeros(0, np.int64)
    for a, b in zip(edges, np.append(edges[1:], len(of))):
        yield int(of[a]), records[a:b]


def cut(h: np.ndarray, records: np.ndarray, slots: int) -> Iterator[tuple[int, bytes]]:
    """(slot, packed records) of records that are in order of their hashes `h`."""
    for slot, part in cut_arrays(h, records, slots):
        yield slot, part.tobytes()


def groups(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys start in sorted arrays."""
    n = len(keys[0])
    new = np.zeros(n, bool)
    if n:
        new[0] = True
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def repeated(values: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """One value per group, repeated over the group's rows."""
    return np.repeat(values, np.diff(np.append(starts, n)))
