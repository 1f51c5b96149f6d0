"""Right-closed binning with labels: a value on an edge belongs to the bin below it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bins:
    """Edges and labels. The lowest edge itself is in no bin, so hour 0 or distance 0 gets NULL."""

    edges: Sequence[float]
    labels: Sequence[str]

    def _chain(self, value: Column, results: Sequence) -> Column:
        chain = None
        for low, high, result in zip(self.edges, self.edges[1:], results):
            inside = value > low
            if high != float("inf"):
                inside = inside & (value <= high)
            else:
                inside = inside & ~F.isnan(value.cast("double"))
            chain = F.when(inside, result) if chain is None else chain.when(inside, result)
        return chain

    def label(self, value: Column | str) -> Column:
        value = F.col(value) if isinstance(value, str) else value
        return self._chain(value, self.labels)

    def rank(self, value: Column | str) -> Column:
        """1-based position of the bin, for ordering."""
        value = F.col(value) if isinstance(value, str) else value
        return self._chain(value, range(1, len(self.labels) + 1))


# The two binnings of the analyses.
HOURS = Bins((0, 6, 12, 18, 24), ("Night (0-6)", "Morning (6-12)", "Afternoon (12-18)", "Evening (18-24)"))
DISTANCES = Bins((0, 5, 10, 15, 20, float("inf")), ("0-5 km", "5-10 km", "10-15 km", "15-20 km", "20+ km"))
