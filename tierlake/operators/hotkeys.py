"""Windows along the timelines of keys, however many rows one key has.

A window over (key order by time) puts a whole key into one task. Here the rows are range-partitioned by key, time and ties
instead: Spark samples the data and cuts it into slots of about equal size, wherever the rows are, so bursts, sentinel dates,
NULL times and keys with a third of all rows are cut as well. Rows of one slot follow those of the slot before in the order of
(key, time), so a window runs per (slot, key), and what a slot needs from its neighbours is one row per slot.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tierlake.functions.scalars import quoted
from tierlake.sources.staging import stage

SLOT = "__slot"
TIE = "__row_hash"


def slotted(frame: DataFrame, keys: Sequence[str], order: Sequence[str], slots: int | None = None) -> DataFrame:
    """A stored copy of the frame with its slot and a hash that breaks ties.

    ``order`` sorts ascending with NULLs last; keys must not be NULL. The number of slots is the session's number of
    shuffle partitions unless ``slots`` names one.
    """
    count = slots or int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = [quoted(f.name) for f in frame.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    tied = frame.withColumn(TIE, F.xxhash64(*hashed))
    ranged = tied.repartitionByRange(count, *[quoted(key) for key in keys], *ascending([*order, TIE]))
    return stage(ranged.withColumn(SLOT, F.spark_partition_id()), "slots")


def ascending(order: Sequence[str]) -> list[Column]:
    return [quoted(name).asc_nulls_last() for name in order]


def place(keys: Sequence[str], order: Sequence[str]) -> Column:
    """A value that compares like (keys, order), NULLs last."""
    parts = [part for name in order for part in (quoted(name).isNull(), quoted(name))]
    return F.struct(*[part.alias("p{}".format(n)) for n, part in enumerate([*[quoted(key) for key in keys], *parts])])


def key_struct(keys: Sequence[str]) -> list[Column]:
    return [quoted(key).alias("k{}".format(number)) for number, key in enumerate(keys)]


def same_key(keys: Sequence[str], other: str) -> Column:
    """Is the row's key the one in the struct column ``other``?"""
    equal = [quoted(key) == F.col("{}.k{}".format(other, number)) for number, key in enumerate(keys)]
    return reduce(lambda left, right: left & right, equal)


def neighbour(
    frame: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    output: str,
    following: bool,
    slots: int | None = None,
) -> DataFrame:
    """Add the value of the following (or preceding) row of the same key; NULL at the end of the key.

    ``order`` names the sort columns, all ascending with NULLs last. Keys must not be NULL.
    """
    shift, edge = (F.lead, F.min_by) if following else (F.lag, F.max_by)
    names = [*order, TIE]
    cut = slotted(frame, keys, order, slots)
    inside = Window.partitionBy(SLOT, *[quoted(key) for key in keys]).orderBy(*ascending(names))
    # The row at a slot's edge is the neighbour of the row at the edge of the slot beside it: one row per slot.
    edges = cut.groupBy(SLOT).agg(edge(F.struct(*key_struct(keys), quoted(value).alias("value")), place(keys, names)).alias("__edge"))
    beside = edges.select(SLOT, shift("__edge").over(Window.orderBy(SLOT)).alias("__beside"))
    own = cut.withColumns({output: shift(value).over(inside), "__more": shift(F.lit(1)).over(inside)})
    carried = F.when(same_key(keys, "__beside"), F.col("__beside.value"))
    return own.join(F.broadcast(beside), SLOT, "left").select(
        *[quoted(name) for name in frame.columns],
        F.when(F.col("__more").isNull(), carried).otherwise(F.col(output)).alias(output),
    )


def last_seen(
    frame: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, output: str, slots: int | None = None
) -> DataFrame:
    """Add the last non-NULL value of the same key up to the row itself; ``order`` as for ``neighbour``."""
    names = [*order, TIE]
    cut = slotted(frame, keys, order, slots)
    known = F.when(quoted(value).isNotNull(), place(keys, names))
    ends = cut.groupBy(SLOT).agg(
        F.max_by(F.struct(*key_struct(keys)), place(keys, names)).alias("__key"),
        F.max_by(F.struct(*key_struct(keys), quoted(value).alias("value")), known).alias("__known"),
    )
    # What each slot's last key has at the slot's end: its last value there, or what came in for it from before.
    last_has_it = [F.col("__known.k{}".format(n)) == F.col("__key.k{}".format(n)) for n in range(len(keys))]
    told = F.when(reduce(lambda left, right: left & right, last_has_it), F.col("__known.value"))
    so_far = Window.partitionBy("__key").orderBy(SLOT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ends.withColumn("__held", F.last(told, ignorenulls=True).over(so_far))
    before = ends.select(SLOT, F.lag(F.struct("__key", "__held")).over(Window.orderBy(SLOT)).alias("__before"))
    within = Window.partitionBy(SLOT, *[quoted(key) for key in keys]).orderBy(*ascending(names))
    within = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = cut.withColumn(output, F.last(quoted(value), ignorenulls=True).over(within))
    carried = F.when(same_key(keys, "__before.__key"), F.col("__before.__held"))
    return own.join(F.broadcast(before), SLOT, "left").select(
        *[quoted(name) for name in frame.columns], F.coalesce(F.col(output), carried).alias(output)
    )
