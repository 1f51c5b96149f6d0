"""Counting the points around probes within one task: probes walk down the tree of their points, many at a time.

The points are halved along the longer side, again and again, until a block has at most ``few``; so all blocks of a level have the
same number of points, whatever the density, and are the rows of an array. A block wholly inside the neighbourhood of a probe adds
its weight, one wholly outside nothing; one on the rim passes the probe on to the four blocks in it or, at the end, to its
points. The pairs of probe and block are arrays, taken in bounded pieces and the deepest first, so memory
depends on the rows handed over and not on the number of pairs, and no pair is ever written.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Any, NamedTuple

import numpy as np

# Pairs of probe and block, or of probe and point, looked at together; they stay in the processor's cache.
PAIRS = 1 << 15
# Places along an axis by which probes are ordered, as a power of two.
ORDER_BITS = 24
#: Steps that move the bits of a number apart: how far, and which bits stay.
_SPREAD = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555))


class Box(NamedTuple):
    """Extent of some places: columns in Spark, arrays in a task."""

    min_lat: Any
    max_lat: Any
    min_lon: Any
    max_lon: Any

    @classmethod
    def of(cls, lat: Any, lon: Any) -> Box:
        return cls(lat, lat, lon, lon)


class Arrays:
    """The functions that distance tests are written in, for arrays."""

    sin, cos, radians, where = np.sin, np.cos, np.radians, np.where

    @staticmethod
    def greatest(*values: Any) -> Any:
        return reduce(np.maximum, values)

    @staticmethod
    def least(*values: Any) -> Any:
        return reduce(np.minimum, values)


@dataclass
class Level:
    """The blocks of a level, a row for each block of the level above: weight, and least and greatest value along each axis."""

    weight: np.ndarray
    low: list[np.ndarray]
    high: list[np.ndarray]


def _fine(values: np.ndarray) -> np.ndarray:
    """Place along an axis of the finest grid over all values."""
    low, cells = values.min(), 1 << ORDER_BITS
    with np.errstate(all="ignore"):
        share = np.nan_to_num((values - low) / (values.max() - low))
    return np.clip(share * cells, 0, cells - 1).astype(np.int64)


def _apart(number: np.ndarray) -> np.ndarray:
    for shift, mask in _SPREAD:
        number = (number | (number << shift)) & mask
    return number


def _halved(lat: np.ndarray, lon: np.ndarray, parts: int) -> np.ndarray:
    """The places in ``parts`` blocks, a power of two that divides their number; a row each, neighbours next to each other."""
    order = np.arange(len(lat))[None, :]
    while len(order) < parts:
        y, x = lat[order], lon[order]
        tall = np.ptp(y, axis=1) >= np.ptp(x, axis=1)
        half = order.shape[1] // 2
        order = np.take_along_axis(order, np.argpartition(np.where(tall[:, None], y, x), half, axis=1), axis=1).reshape(-1, half)
    return order


def _tree(points: dict[str, np.ndarray], axes: list[np.ndarray], few: int) -> list[Level]:
    """The levels of blocks from the top, and last the points of each block."""
    n = len(points["lat"])
    depth = (-(-n // few) - 1).bit_length()
    # Blocks are filled up with copies of a point that weigh nothing.
    filled = np.minimum(np.arange(-(-n // (1 << depth)) << depth), n - 1)
    weight = np.where(np.arange(len(filled)) < n, points["weight"][filled], 0)
    order = _halved(points["lat"][filled], points["lon"][filled], 1 << depth)
    at = filled[order]
    levels = [Level(weight[order], edges := [a[at] for a in axes], edges)]
    low, high, weight = [e.min(axis=1) for e in edges], [e.max(axis=1) for e in edges], levels[0].weight.sum(axis=1)
    while depth >= 0:
        fan = 4 if depth >= 2 else 1 << depth
        levels.append(Level(weight.reshape(-1, fan), [e.reshape(-1, fan) for e in low], [e.reshape(-1, fan) for e in high]))
        low, high = [e.min(axis=1) for e in levels[-1].low], [e.max(axis=1) for e in levels[-1].high]
        weight = levels[-1].weight.sum(axis=1)
        depth = depth - 2 if depth >= 2 else -1
    return levels[::-1]


def count(near: Any, few: int, probes: dict[str, np.ndarray], points: dict[str, np.ndarray], same: tuple[str, ...] = ()) -> np.ndarray:
    """The weight near each probe, where the columns ``same`` are given of the points that agree in them."""
    walk = near.in_task(probes, points)
    n = len(walk.point)
    mine = [*walk.probe, *(probes[c] for c in same)]
    levels = _tree(points, [*walk.point, points["lat"], points["lon"], *(points[c] for c in same)], few)
    # The coordinates of the points are only looked at one by one.
    found = np.zeros(len(probes["lat"]), np.int64)
    first = np.argsort(_apart(_fine(probes["lon"])) | (_apart(_fine(probes["lat"])) << 1))
    pending = [(0, first, np.zeros(len(first), np.int64))]
    while pending:
        at, probe, block = pending.pop()
        level = levels[at]
        fan = level.weight.shape[1]
        piece = max(1, PAIRS // fan)
        if len(probe) > piece:
            pending.append((at, probe[piece:], block[piece:]))
            probe, block = probe[:piece], block[:piece]
        q = [a[probe][:, None] for a in mine]
        low = [np.take(e, block, axis=0) for e in (*level.low[:n], *level.low[n + 2 :])]
        weight = np.take(level.weight, block, axis=0)
        if at == len(levels) - 1:
            hit, unsure = walk.points(q[:n], low[:n])
            if unsure is not None and unsure.any():
                row, one = np.nonzero(unsure)
                lat, lon = (e[block[row], one] for e in level.low[n : n + 2])
                hit[row, one] = near.matches(probes["lat"][probe[row]], probes["lon"][probe[row]], lat, lon)
            for mark, value in zip(q[n:], low[n:]):
                hit &= value == mark
            np.add.at(found, probe, (weight * hit).sum(axis=1))
            continue
        high = [np.take(e, block, axis=0) for e in (*level.high[:n], *level.high[n + 2 :])]
        may, whole = walk.blocks(q[:n], low[:n], high[:n])
        for mark, least, most in zip(q[n:], low[n:], high[n:]):
            may &= (least <= mark) & (mark <= most)
            whole &= (least == mark) & (mark == most)
        np.add.at(found, probe, (weight * whole).sum(axis=1))
        row, one = np.nonzero(may & ~whole)
        if len(row):
            pending.append((at + 1, probe[row], block[row] * fan + one))
    return found
