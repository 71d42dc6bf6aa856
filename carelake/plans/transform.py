"""Transformations as lists of named steps, one list per source table.

A build that is written this way says per source what happens to its rows, in order, and
can be asked how many rows each step left: the counts are observed while the build's own
job runs, so they cost no further pass.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from carelake.functions.dates import parse_date
from carelake.sources.tables import Sources


@dataclass(frozen=True)
class Step:
    """One named change of a table."""

    name: str
    apply: Callable[[DataFrame], DataFrame]


def selecting(name: str, *columns) -> Step:
    return Step(name, lambda df: df.select(*columns))


def dated(column: str) -> Step:
    """``dd/MM/yyyy`` text of a column read as a date."""
    return Step(f"date {column}", lambda df: df.withColumn(column, parse_date(column)))


class StepCounts:
    """Rows after each step, known once a job has run the plan."""

    def __init__(self) -> None:
        self._seen: list[tuple[str, str, Observation]] = []

    def watch(self, df: DataFrame, source: str, step: str) -> DataFrame:
        seen = Observation(f"{source}/{len(self._seen)}/{step}")
        self._seen.append((source, step, seen))
        return df.observe(seen, F.count(F.lit(1)).alias("rows"))

    def rows(self) -> list[tuple[str, int, str, int]]:
        """(source, position, step, rows), in the order in which the steps were added.
        A step that the optimiser found empty without running it has 0 rows."""
        at: dict[str, int] = {}
        out = []
        for source, step, seen in self._seen:
            at[source] = at.get(source, 0) + 1
            out.append((source, at[source], step, seen.get.get("rows", 0)))
        return out


def run_steps(df: DataFrame, source: str, steps: Iterable[Step], counts: StepCounts | None = None) -> DataFrame:
    """The table after all steps.  Counting a step keeps the optimiser from moving work
    across it, so steps are counted only where ``counts`` asks for it."""
    for step in steps:
        df = step.apply(df)
        if counts is not None:
            df = counts.watch(df, source, step.name)
    return df


def run_plan(src: Sources, plan: Mapping[str, Iterable[Step]], counts: StepCounts | None = None) -> dict[str, DataFrame | None]:
    """Each source of the plan after its steps; an absent source stays None."""
    out: dict[str, DataFrame | None] = {}
    for source, steps in plan.items():
        df = src.get(source)
        out[source] = None if df is None else run_steps(df, source, steps, counts)
    return out
