"""The triangle job: a numbered edge stream in, estimates and their errors out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from sparkmine.operators import edges as edge_ops
from sparkmine.operators import triangles
from sparkmine.operators.reservoir import Run, lifetimes, replacement_log, sample_at
from sparkmine.operators.storage import durable


def size_by_ratio(n_edges: int, ratio: float) -> int:
    """Reservoir size as a share of the edges."""
    return int(ratio * n_edges)


@dataclass(frozen=True)
class TriangleStream:
    """Triangle estimates over ``edges(t, a, b)``, one per run."""

    edges: DataFrame
    runs: Sequence[Run]

    @cached_property
    def lives(self) -> DataFrame:
        """Which edge was in which reservoir slot, and when."""
        return durable(lifetimes(self.edges, self.runs, ["a", "b"]), "lives")

    @cached_property
    def final_sample(self) -> DataFrame:
        return sample_at(self.lives)

    @cached_property
    def log(self) -> DataFrame:
        return replacement_log(self.lives, ["a", "b"])

    @cached_property
    def contributions(self) -> DataFrame:
        return triangles.contributions(self.edges, self.lives)

    @cached_property
    def estimates(self) -> DataFrame:
        """``run, size, estimate``."""
        return triangles.estimate(self.contributions, self.lives)

    def history(self, every: int = 2000) -> DataFrame:
        """``t, estimate`` of the first run at every ``every``-th edge."""
        first = self.contributions.filter("run = 1")
        return triangles.history(self.edges, first, every, self.edges.count())

    def errors(self) -> DataFrame:
        """Estimates against the exact count."""
        return triangles.with_errors(self.estimates, edge_ops.exact_triangles(self.edges))
