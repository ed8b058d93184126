"""Row numbers and pages of a sorted table, without a window over the whole table.

The rows are range-partitioned by their order (``hotkeys.slotted``) and stored. A count per slot and its prefix sums tell at
which number each slot begins, and a row's number is that plus its place in the slot. A page then reads the slots it touches:
the others' row groups are skipped by the slot's bounds in their footers. What the driver sees is one row per slot.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from tierlake.functions.scalars import quoted
from tierlake.operators.hotkeys import SLOT, TIE, ascending, slotted
from tierlake.sources.staging import stage

NUMBER = "__number"
_START = "__start"


@dataclass(frozen=True)
class Ranking:
    """A table in a fixed order: rows sorted ascending by ``order`` (NULLs last, then by a hash of the row)."""

    rows: DataFrame
    starts: DataFrame
    order: tuple[str, ...]
    columns: tuple[str, ...]

    @property
    def size(self) -> int:
        """Number of rows."""
        return self.starts.agg(F.sum("rows")).first()[0] or 0

    def _place(self, rows: DataFrame, starts: DataFrame, output: str) -> DataFrame:
        inside = Window.partitionBy(SLOT).orderBy(*ascending([*self.order, TIE]))
        placed = rows.join(starts.select(SLOT, _START), SLOT).withColumn(NUMBER, F.row_number().over(inside) - 1 + F.col(_START))
        return placed.select(*[quoted(name) for name in self.columns], F.col(NUMBER).alias(output))

    def numbered(self, output: str = "row_number") -> DataFrame:
        """All rows with their number, from 0."""
        return self._place(self.rows, self.starts, output)

    def slice(self, offset: int, limit: int, output: str = NUMBER) -> DataFrame:
        """Rows number ``offset`` up to ``offset + limit - 1``, as many as there are, with their number."""
        if offset < 0 or limit < 1:
            raise ValueError("A page needs an offset of 0 or more and a limit of 1 or more")
        touched = self.starts.filter((F.col(_START) < offset + limit) & (F.col(_START) + F.col("rows") > offset))
        first, last = touched.agg(F.min(SLOT), F.max(SLOT)).first()
        if first is None:
            near, touched = self.rows.limit(0), self.starts
        else:
            near = self.rows.filter(F.col(SLOT).between(first, last))
        return self._place(near, touched, output).filter(F.col(output).between(offset, offset + limit - 1))

    def page(self, offset: int, limit: int) -> DataFrame:
        """The table's own columns of a slice."""
        return self.slice(offset, limit).drop(NUMBER)

    def pages(self, page_size: int, max_rows: int, output: str = "page") -> tuple[DataFrame, bool]:
        """The first ``max_rows`` rows with the number of their page, and whether rows were left out."""
        if page_size < 1 or max_rows < 1:
            raise ValueError("page_size and max_rows must be above 0")
        cut = self.slice(0, max_rows)
        paged = cut.withColumn(output, F.floor(F.col(NUMBER) / page_size).cast("long")).drop(NUMBER)
        return paged, self.size > max_rows


def rank(frame: DataFrame, order: Sequence[str], slots: int | None = None) -> Ranking:
    """Store the frame in order and count its slots. Rows equal in ``order`` follow each other by a hash of all their columns."""
    rows = slotted(frame, (), order, slots)
    before = Window.orderBy(SLOT).rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(SLOT).agg(F.count(F.lit(1)).alias("rows"))
    starts = counts.withColumn(_START, F.coalesce(F.sum("rows").over(before), F.lit(0)))
    return Ranking(rows, stage(starts, "starts"), tuple(order), tuple(frame.columns))
