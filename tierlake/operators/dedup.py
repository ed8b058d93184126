"""One row per key, decided the same way on every run."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tierlake.functions.scalars import hash_key, quoted

STRATEGIES = ("snapshot", "history")
_RANK = "__rank"


@dataclass(frozen=True)
class Dedup:
    """``snapshot`` keeps the latest row per key; ``history`` keeps one row per key and content hash."""

    keys: tuple[str, ...]
    strategy: str = "snapshot"
    order_by: tuple[str, ...] = ()
    hash_column: str = "hash_data"
    hash_columns: tuple[str, ...] | None = None
    hash_exclude: tuple[str, ...] = ()


def _sortable(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.ArrayType):
        return _sortable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_sortable(field.dataType) for field in data_type.fields)
    return not isinstance(data_type, (T.MapType, T.VariantType, T.CalendarIntervalType))


def first_per_key(
    frame: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), ordered: Sequence[str] = ()
) -> DataFrame:
    """The first row of each key in the given order; ``ordered`` names the columns that ``order`` already covers.

    All other columns break ties (ascending, NULLs last), so only rows that agree in every sortable column are
    interchangeable. Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle: each task
    sends at most one row per key, however many copies a key has.
    """
    settled = {name.lower() for name in (*keys, *ordered)}
    ties = [
        quoted(field.name).asc_nulls_last()
        for field in frame.schema.fields
        if field.name.lower() not in settled and _sortable(field.dataType)
    ]
    sort = [*order, *ties] or [F.col(keys[0])]
    window = Window.partitionBy(*keys).orderBy(*sort)
    return frame.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def latest_per_key(frame: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row with the greatest order columns per key, NULLs last."""
    return first_per_key(frame, keys, [F.col(name).desc_nulls_last() for name in order_by], order_by)


def hashed_columns(frame: DataFrame, dedup: Dedup) -> list[str]:
    """Columns that make up the content hash."""
    if dedup.hash_columns is not None:
        return list(dedup.hash_columns)
    return [name for name in frame.columns if name not in dedup.hash_exclude]


def deduplicate(frame: DataFrame, dedup: Dedup | None, existing: DataFrame | None = None) -> DataFrame:
    """Apply a de-duplication. In history mode, rows whose key and hash ``existing`` already holds are left out."""
    if dedup is None:
        return frame
    if dedup.strategy == "snapshot":
        return latest_per_key(frame, dedup.keys, dedup.order_by)
    if dedup.strategy == "history":
        hashed = frame.withColumn(dedup.hash_column, hash_key(hashed_columns(frame, dedup)))
        keys = [*dedup.keys, dedup.hash_column]
        versions = latest_per_key(hashed, keys, dedup.order_by)
        if existing is None:
            return versions
        known = existing.select(*keys)
        return versions.alias("new").join(
            known.alias("known"),
            [F.col("new.`{0}`".format(key)).eqNullSafe(F.col("known.`{0}`".format(key))) for key in keys],
            "left_anti",
        )
    raise ValueError("No such deduplication strategy: {}".format(dedup.strategy))
