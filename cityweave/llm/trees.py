"""Trees of Spark ML models as plain data."""

from __future__ import annotations

import re
from typing import NamedTuple

_SPLIT = re.compile(r"^( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)$")
_LEAF = re.compile(r"^( *)Predict: (\S+)$")


class Condition(NamedTuple):
    feature: int
    above: bool  # value > threshold, else value <= threshold
    threshold: float


class Leaf(NamedTuple):
    path: tuple[Condition, ...]
    value: float


def leaves(tree) -> list[Leaf]:
    """All leaves of a Spark ML tree on continuous features, each with the conditions on its path."""
    found, path = [], []
    for line in tree.toDebugString.splitlines():
        if split := _SPLIT.match(line):
            depth = len(split[1])
            path = [(d, c) for d, c in path if d < depth]
            path.append((depth, Condition(int(split[3]), split[4] == ">", float(split[5]))))
        elif leaf := _LEAF.match(line):
            depth = len(leaf[1])
            path = [(d, c) for d, c in path if d < depth]
            found.append(Leaf(tuple(c for _, c in path), float(leaf[2])))
    return found


def rules(trees) -> list[tuple[Condition, ...]]:
    """The distinct conjunctions that lead to a node of any of the trees, the longer after the shorter.

    Of conditions on one feature in one direction only the strictest stays, and a condition and its opposite
    alone are one rule.
    """
    distinct = set()
    for tree in trees:
        for leaf in leaves(tree):
            for n in range(1, len(leaf.path) + 1):
                strictest: dict[tuple[int, bool], float] = {}
                for feature, above, threshold in leaf.path[:n]:
                    pick = max if above else min
                    strictest[feature, above] = pick(strictest.get((feature, above), threshold), threshold)
                rule = tuple(sorted(Condition(f, a, t) for (f, a), t in strictest.items()))
                if len(rule) == 1:
                    rule = (rule[0]._replace(above=True),)
                distinct.add(rule)
    return sorted(distinct, key=lambda r: (len(r), r))
