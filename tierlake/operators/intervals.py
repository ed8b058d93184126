"""Every version valid at a moment, where a key has many versions that overlap: an interval join by time buckets.

Time is cut into buckets at several levels, 8 times wider from one level to the next. A version goes to the level whose
buckets are at most as wide as its validity, into each bucket it touches: 9 at most, however long it is. A moment lies in
one bucket of every level that has versions. The join is an equi-join on (key, level, bucket), so a task gets moments only
together with versions that are valid nearby, and the exact bounds decide. A version that meets a moment meets it once.

Open ends are cut to the span of the moments asked for, so every version has a length.

Rows multiply on both sides after they were stored, and what is stored packs well (few keys, even times), so a file's size says
little about rows in memory: both sides are always shuffled and sorted, none is broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tierlake.functions.scalars import quoted
from tierlake.sources.staging import stage

#: Each level's buckets are 2 ** LEVEL_BITS times as wide as those of the level below.
LEVEL_BITS = 3
_INSTANTS = (T.DateType, T.TimestampType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def ticks(kinds: Sequence[T.DataType]):
    """How to turn values of these types into whole numbers that compare like them; None if there is no such way."""
    if all(isinstance(kind, _WHOLE) for kind in kinds):
        return lambda value: value.cast("long")
    if all(isinstance(kind, _INSTANTS) for kind in kinds):
        return lambda value: F.unix_micros(value.cast("timestamp"))
    if all(isinstance(kind, T.TimestampNTZType) for kind in kinds):
        # The difference of two local times knows no time zone.
        since = F.expr("timestamp_ntz'1970-01-01 00:00:00'")
        return lambda value: ((value - since).cast("interval second").cast("decimal(18,6)") * 1_000_000).cast("long")
    return None


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def valid_versions(
    asked: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, start: str, end: str, value: str
) -> DataFrame:
    """(keys, ``at``, ``value``): one row for every row of ``asked`` and version of its keys that is valid then.

    Both bounds are inclusive, a NULL end is open, a version with a NULL start or one that ends before it starts is never
    valid; NULL keys and moments find nothing. The three times are dates or timestamps, all without time zone, or whole
    numbers. ``asked`` should hold distinct rows; repeated versions are versions of their own.
    """
    tick = ticks([asked.schema[at].dataType, versions.schema[start].dataType, versions.schema[end].dataType])
    if tick is None:
        raise TypeError("Times are dates, timestamps or whole numbers, and of one kind")
    named = [F.col("__k{}".format(n)).isNotNull() for n in range(len(keys))]
    wanted = asked.select(
        *[quoted(key).alias("__k{}".format(n)) for n, key in enumerate(keys)], quoted(at).alias("__at"), tick(quoted(at)).alias("__t")
    ).filter(_all([*named, F.col("__t").isNotNull()]))
    wanted = stage(wanted, "asked")
    first, last = wanted.agg(F.min("__t"), F.max("__t")).first()
    # No moment: any span gives no row.
    first, last = (0, 0) if first is None else (first, last)
    from_, to = F.greatest(F.col("__from"), F.lit(first)), F.least(F.coalesce(F.col("__to"), F.lit(last)), F.lit(last))
    known = (
        versions.select(
            *[quoted(key).alias("__k{}".format(n)) for n, key in enumerate(keys)],
            tick(quoted(start)).alias("__from"),
            tick(quoted(end)).alias("__to"),
            quoted(value).alias("__value"),
        )
        .filter(_all([*named, F.col("__from").isNotNull(), F.col("__to").isNull() | (F.col("__from") <= F.col("__to"))]))
        .withColumns({"__from": from_, "__to": to})
        .filter("__from <= __to")
        # The number of bits of the length, as whole levels.
        .withColumn("__level", F.expr("cast((length(bin(__to - __from + 1)) - 1) div {} as int)".format(LEVEL_BITS)))
    )
    known = stage(known, "versions")
    levels = [row[0] for row in known.select("__level").distinct().collect()]  # 22 at most
    bucket = "shiftright({}, {} * __level)"
    touched = "sequence({}, {})".format(bucket.format("__from", LEVEL_BITS), bucket.format("__to", LEVEL_BITS))
    placed = known.withColumn("__bucket", F.explode(F.expr(touched)))
    every = F.explode(F.array(*[F.lit(level) for level in levels]).cast("array<int>"))
    probes = wanted.withColumn("__level", every).withColumn("__bucket", F.expr(bucket.format("__t", LEVEL_BITS)))
    names = ["__k{}".format(n) for n in range(len(keys))]
    met = probes.hint("merge").join(placed, [*names, "__level", "__bucket"]).filter("__t between __from and __to")
    return met.select(*[F.col(name).alias(key) for name, key in zip(names, keys)], F.col("__at").alias(at), F.col("__value").alias(value))
