"""The monthly cost run as one composition of lazy operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame

from skyledger.operators import allocation, cost
from skyledger.session import cut_lineage

LEVELS = {
    0: allocation.allocate_compute,
    1: allocation.allocate_compute_and_transfer,
    2: allocation.allocate_with_residual,
}


def monthly_cost(
    cur: DataFrame,
    workload_metrics: DataFrame,
    app_metrics: DataFrame,
    year: str | int,
    month: str | int,
    tags: Sequence[str] = ("project",),
    level: int = 2,
    stage: Callable[[DataFrame, str], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Standardise, allocate to workloads, then untag and unit cost, both on the allocated table.

    The standardised and the allocated table are stored in the scratch folder, as each has several readers. ``stage``
    stores them elsewhere or not at all: it is given each of the two and its name.
    """
    keep = stage or (lambda df, name: cut_lineage(df))
    standard = keep(cost.standardize(cur, year, month), "standard")

    def month_of(df: DataFrame) -> DataFrame:
        return df.where((df["year"] == str(int(year))) & (df["month"] == str(int(month))))

    allocated = keep(LEVELS[level](month_of(workload_metrics), standard), "allocated")
    return {
        "standard": standard,
        "allocated": allocated,
        "untagged": allocation.allocate_untagged(allocated, tags),
        "unit_cost": cost.unit_cost(month_of(app_metrics), allocated),
    }
