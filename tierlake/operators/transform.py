"""Projection, SQL expressions and group metrics attached to every row."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tierlake.sources.staging import stage

# Aggregate functions a configuration may name.
AGGREGATES = {"avg": F.avg, "count": F.count, "max": F.max, "min": F.min, "sum": F.sum}


@dataclass(frozen=True)
class OutputColumn:
    """A column of a result: a renamed source column or a SQL expression."""

    name: str
    source: str | None = None
    expression: str | None = None

    def column(self) -> Column:
        value = F.expr(self.expression) if self.expression is not None else F.col(self.source or self.name)
        return value.alias(self.name)


@dataclass(frozen=True)
class Expression:
    """Add (or replace) one column by SQL text; any Spark SQL function may be used."""

    name: str
    expression: str


@dataclass(frozen=True)
class Metric:
    """One aggregate. Without a column it sees every row, so ``count`` counts rows."""

    name: str
    function: str
    column: str = "*"

    def aggregate(self) -> Column:
        if self.function not in AGGREGATES:
            raise ValueError("No such metric function: {}".format(self.function))
        value = F.lit(1) if self.column == "*" else F.col(self.column)
        return AGGREGATES[self.function](value).alias(self.name)


@dataclass(frozen=True)
class Enrichment:
    """Group metrics that are attached to every row of the group."""

    group_by: tuple[str, ...]
    metrics: tuple[Metric, ...]


def project(frame: DataFrame, columns: Sequence[OutputColumn]) -> DataFrame:
    """Keep the listed columns under their new names; an empty list keeps everything."""
    return frame.select(*[column.column() for column in columns]) if columns else frame


def add_expressions(frame: DataFrame, expressions: Sequence[Expression]) -> DataFrame:
    """Add columns one after another; later ones see earlier ones. Catalyst folds them into one projection."""
    for item in expressions:
        frame = frame.withColumn(item.name, F.expr(item.expression))
    return frame


def group_metrics(frame: DataFrame, enrichment: Enrichment) -> DataFrame:
    """One row per group. Spark aggregates before the shuffle, so a hot group sends one row per task."""
    return frame.groupBy(*enrichment.group_by).agg(*[metric.aggregate() for metric in enrichment.metrics])


def _merged(enrichments: Sequence[Enrichment]) -> list[Enrichment]:
    """Neighbours over the same groups become one aggregation, unless the later one reads the earlier one's result."""
    merged: list[Enrichment] = []
    for item in enrichments:
        last = merged[-1] if merged else None
        made = {metric.name.lower() for metric in last.metrics} if last else set()
        if last and last.group_by == item.group_by and not made & _needed(item):
            merged[-1] = Enrichment(item.group_by, last.metrics + item.metrics)
        else:
            merged.append(item)
    return merged


def _needed(item: Enrichment) -> set[str]:
    return {name.lower() for name in item.group_by} | {metric.column.lower() for metric in item.metrics}


def enrich(frame: DataFrame, enrichments: Sequence[Enrichment]) -> DataFrame:
    """Attach group metrics to every row, group columns first; rows with a NULL group column get NULL metrics.

    The metrics are staged before the join. Their true size then decides how they reach the rows: small ones are
    broadcast and the rows are not shuffled at all; large ones are shuffled, and as both join inputs are plain
    shuffle stages AQE splits the partition of a hot group. Enrichments that need no result of an earlier one are
    aggregated from the same input.
    """
    base, produced = frame, set()
    for item in _merged(enrichments):
        if _needed(item) & produced:
            base, produced = frame, set()
        metrics = stage(group_metrics(base, item), "metrics")
        frame = frame.join(metrics, on=list(item.group_by), how="left")
        produced |= {metric.name.lower() for metric in item.metrics}
    return frame


def apply_commands(frame: DataFrame, commands: Sequence[Expression | Enrichment]) -> DataFrame:
    """Run expressions and enrichments in the given order."""
    position = 0
    while position < len(commands):
        kind = type(commands[position])
        end = position
        while end < len(commands) and type(commands[end]) is kind:
            end += 1
        run = commands[position:end]
        if kind is Expression:
            frame = add_expressions(frame, run)
        elif kind is Enrichment:
            frame = enrich(frame, run)
        else:
            raise ValueError("Commands are expressions or enrichments, not {}".format(kind.__name__))
        position = end
    return frame
