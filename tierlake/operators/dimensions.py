"""Dimensions of type 1 (current values) and type 2 (versions with validity ranges)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tierlake.functions.scalars import hash_key, quoted
from tierlake.operators.dedup import first_per_key, latest_per_key
from tierlake.operators.hotkeys import neighbour
from tierlake.operators.transform import OutputColumn

HASH_COLUMN = "hash_data"
DETECT = ("distinct", "changes")


@dataclass(frozen=True)
class Dimension:
    """How to build one dimension.

    ``valid_from`` is the time column of a type 2 dimension; on a type 1 dimension it picks the latest row. ``detect``
    says what a new version is: ``distinct`` keeps the first sight of every content hash per key (a value that comes
    back opens no version), ``changes`` opens one whenever the content differs from the one before.
    """

    name: str
    business_key: tuple[str, ...]
    surrogate_key: str
    columns: tuple[OutputColumn, ...] = ()
    source_columns: tuple[str, ...] = ()
    scd_type: int = 1
    valid_from: str | None = None
    tracked: tuple[str, ...] | None = None
    detect: str = "distinct"
    null_token: str | None = None
    path: str | None = None

    @property
    def location(self) -> str:
        return self.path or self.name


def stack_columns(frame: DataFrame, sources: Sequence[str], name: str) -> DataFrame:
    """Several columns as one, in one scan: a row per source column."""
    return frame.select(F.explode(F.array(*[F.col(source) for source in sources])).alias(name))


def members(frame: DataFrame, dimension: Dimension) -> DataFrame:
    """The configured columns of all rows whose business key is complete."""
    if dimension.source_columns:
        frame = stack_columns(frame, dimension.source_columns, dimension.columns[0].name)
    else:
        frame = frame.select(*[column.column() for column in dimension.columns])
    complete = [F.col(key).isNotNull() for key in dimension.business_key]
    return frame.filter(reduce(lambda left, right: left & right, complete))


def current_members(frame: DataFrame, dimension: Dimension) -> DataFrame:
    """Type 1: one row per business key, the latest when a time column is named.

    When the columns are just the key (and the time), a plain hash aggregation does it: the map side already reduces
    every key to one row and nothing is sorted. Without a time the other columns are taken to describe the key, so
    equal rows are folded the same way before one row per key is picked from the few that are left.
    """
    rows = members(frame, dimension)
    names, keys, time = rows.columns, list(dimension.business_key), dimension.valid_from
    others = [name for name in names if name not in keys]
    if not others:
        rows = rows.distinct()
    elif others == [time]:
        rows = rows.groupBy(*keys).agg(F.max(time).alias(time)).select(*[quoted(name) for name in names])
    elif time is None:
        rows = first_per_key(rows.distinct(), keys)
    else:
        rows = latest_per_key(rows, keys, [time])
    return rows.withColumn(dimension.surrogate_key, hash_key(keys, dimension.null_token))


def _first_seen(rows: DataFrame, keys: list[str], tracked: list[str], null_token: str | None) -> DataFrame:
    """The earliest row of every (business key, content hash).

    Rows that agree in all but the time are reduced by a hash aggregation first, when the columns allow it: not if the time
    itself is tracked or part of the key.
    """
    names = rows.columns
    others = [name for name in names if name != "valid_from"]
    timeless = "valid_from" not in (*keys, *tracked)
    if timeless and set(others) <= {*keys, *tracked}:
        earliest = rows.groupBy(*[quoted(name) for name in others]).agg(F.min("valid_from").alias("valid_from"))
        rows = earliest.select(*[quoted(name) for name in names])
    hashed = rows.withColumn(HASH_COLUMN, hash_key(tracked, null_token))
    if timeless and set(others) <= set(keys):
        return hashed
    return first_per_key(hashed, [*keys, HASH_COLUMN], [F.col("valid_from").asc_nulls_last()], ["valid_from"])


def _changed(
    rows: DataFrame, keys: list[str], tracked: list[str], null_token: str | None, slots: int | None
) -> DataFrame:
    """Rows whose content hash differs from the row before them in time."""
    hashed = rows.withColumn(HASH_COLUMN, hash_key(tracked, null_token))
    ties = [name for name in (HASH_COLUMN, *rows.columns) if name not in (*keys, "valid_from")]
    compared = neighbour(hashed, keys, ["valid_from", *ties], HASH_COLUMN, "__before", False, slots)
    changed = F.col("__before").isNull() | (F.col("__before") != F.col(HASH_COLUMN))
    return compared.filter(changed).select(*[quoted(name) for name in hashed.columns])


def _timed(dimension: Dimension, names: Sequence[str]) -> list[str]:
    """The names with that of the time column as it is in a version."""
    return ["valid_from" if name == dimension.valid_from else name for name in names]


def version_keys(dimension: Dimension) -> list[str]:
    """The business key's columns in a version."""
    return _timed(dimension, dimension.business_key)


def version_rows(frame: DataFrame, dimension: Dimension) -> DataFrame:
    """The rows that versions are made of: the configured columns, the time named ``valid_from``."""
    return members(frame, dimension).withColumnRenamed(dimension.valid_from, "valid_from")


def versions(frame: DataFrame, dimension: Dimension, slots: int | None = None) -> DataFrame:
    """Type 2 from the rows of a frame; see ``build_versions``."""
    return build_versions(version_rows(frame, dimension), dimension, slots)


def build_versions(rows: DataFrame, dimension: Dimension, slots: int | None = None) -> DataFrame:
    """Type 2: one row per version, valid from its time until one microsecond before the next version.

    The last version of a key has no end and is current. Versions with one and the same start are ordered by hash; all
    but the last of them end before they start. A NULL start sorts last and has no end either.
    """
    keys, tracked = version_keys(dimension), _timed(dimension, dimension.tracked or dimension.business_key)
    if dimension.detect == "changes":
        found = _changed(rows, keys, tracked, dimension.null_token, slots)
    else:
        found = _first_seen(rows, keys, tracked, dimension.null_token)

    names = found.columns
    if dimension.detect == "distinct" and set(tracked) <= set(keys):
        # The content is part of the key, so every key has exactly one version and no window is needed.
        followed = found.withColumn("__next", F.lit(None).cast(found.schema["valid_from"].dataType))
    else:
        followed = neighbour(found, keys, ["valid_from", HASH_COLUMN], "valid_from", "__next", True, slots)
    return followed.select(
        *[quoted(name) for name in names],
        F.expr("__next - INTERVAL 1 MICROSECOND").alias("valid_to"),
        F.col("__next").isNull().alias("is_current"),
        hash_key([*keys, HASH_COLUMN], dimension.null_token).alias(dimension.surrogate_key),
    )


def build_dimension(frame: DataFrame, dimension: Dimension, slots: int | None = None) -> DataFrame:
    """One dimension of either type."""
    if dimension.scd_type == 1:
        return current_members(frame, dimension)
    if dimension.scd_type == 2:
        return versions(frame, dimension, slots)
    raise ValueError("{}: type is 1 or 2, not {}".format(dimension.name, dimension.scd_type))
