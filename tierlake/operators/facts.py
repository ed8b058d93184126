"""Facts: projected measures plus the surrogate keys of their dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tierlake.functions.scalars import quoted
from tierlake.operators.dimensions import HASH_COLUMN, Dimension
from tierlake.operators.hotkeys import last_seen
from tierlake.operators.intervals import ticks, valid_versions
from tierlake.operators.transform import OutputColumn
from tierlake.sources.staging import stage


@dataclass(frozen=True)
class DimensionJoin:
    """Look up one dimension. ``effective_at`` picks the version valid at that time (type 2 only).

    A join that can find several members for one fact row (a type 2 dimension without a time, or other target columns than
    the business key) multiplies rows and has to ask for it with ``fan_out``.
    """

    dimension: str
    source_key: tuple[str, ...]
    target_key: tuple[str, ...]
    output_key: str | None = None
    effective_at: str | None = None
    fan_out: bool = False

    def finds_one(self, dimension: Dimension) -> bool:
        """Has every fact row at most one matching member?"""
        whole_key = set(self.target_key) == set(dimension.business_key)
        return whole_key and (dimension.scd_type == 1 or self.effective_at is not None)


@dataclass(frozen=True)
class Fact:
    name: str
    columns: tuple[OutputColumn, ...]
    joins: tuple[DimensionJoin, ...] = ()
    path: str | None = None

    @property
    def location(self) -> str:
        return self.path or self.name


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def _attach(fact: DataFrame, dimension: DataFrame, condition: Column, surrogate: str, output: str) -> DataFrame:
    joined = fact.alias("fact").join(dimension.alias("dim"), condition, "left")
    return joined.select("fact.*", F.col("dim.{}".format(surrogate)).alias(output))


def _same_keys(pairs: Sequence[tuple[str, str]]) -> list[Column]:
    return [F.col("fact.{}".format(source)) == F.col("dim.{}".format(target)) for source, target in pairs]


def lookup(
    fact: DataFrame, dimension: DataFrame, pairs: Sequence[tuple[str, str]], surrogate: str, output: str
) -> DataFrame:
    """Left equi-join that adds the surrogate key; every fact row stays, NULL or unknown keys get NULL.

    No hint is given: a stored dimension has a known size, so the planner broadcasts it below its limit and shuffles
    both sides above it, where AQE splits the partition of a hot fact key.
    """
    return _attach(fact, dimension, _all(_same_keys(pairs)), surrogate, output)


def lookup_between(
    fact: DataFrame, dimension: DataFrame, pairs: Sequence[tuple[str, str]], at: str, surrogate: str, output: str
) -> DataFrame:
    """Every version valid at the time: an equi-join with a range condition, both bounds inclusive."""
    moment, start, end = F.col("fact.{}".format(at)), F.col("dim.valid_from"), F.col("dim.valid_to")
    valid = [moment >= start, end.isNull() | (moment <= end)]
    return _attach(fact, dimension, _all([*_same_keys(pairs), *valid]), surrogate, output)


def lookup_valid(
    fact: DataFrame, dimension: DataFrame, pairs: Sequence[tuple[str, str]], at: str, surrogate: str, output: str
) -> DataFrame:
    """Every version valid at the time, by an interval join: the same rows as ``lookup_between``.

    Distinct (key, time) pairs meet the versions valid nearby, and the facts join what they found on exactly that. Times the
    interval join doesn't know (text, say) take the plain join. What they found repeats moments and versions, so its file is
    far smaller than its rows; the hint keeps it from being broadcast by the file's size.
    """
    kinds = [fact.schema[at].dataType, dimension.schema["valid_from"].dataType, dimension.schema["valid_to"].dataType]
    if ticks(kinds) is None:
        return lookup_between(fact, dimension, pairs, at, surrogate, output)
    keys = ["__key{}".format(number) for number in range(len(pairs))]
    asked = fact.select(*[F.col(source).alias(key) for key, (source, _) in zip(keys, pairs)], F.col(at).alias("__moment")).distinct()
    known = dimension.select(
        *[F.col(target).alias(key) for key, (_, target) in zip(keys, pairs)], "valid_from", "valid_to", quoted(surrogate).alias("__found")
    )
    met = valid_versions(asked, known, keys, "__moment", "valid_from", "valid_to", "__found")
    matched = [(source, key) for key, (source, _) in zip(keys, pairs)] + [(at, "__moment")]
    return lookup(fact, stage(met, "valid").hint("merge"), matched, "__found", output)


def lookup_sorted(
    fact: DataFrame,
    dimension: DataFrame,
    pairs: Sequence[tuple[str, str]],
    at: str,
    surrogate: str,
    output: str,
    slots: int | None = None,
) -> DataFrame:
    """Point-in-time lookup whose cost is linear in facts plus versions, however many versions a key has.

    Distinct (key, time) pairs and versions are sorted together and the last version seen is carried forward, so ``pairs``
    must cover the business key: then versions don't overlap and at most one is valid. The result is one row per (key,
    time), and the facts join it on exactly that.
    """
    keys = ["__k{}".format(number) for number in range(len(pairs))]
    asked = (
        fact.select(*[F.col(source).alias(key) for key, (source, _) in zip(keys, pairs)], F.col(at).alias("__at"))
        .filter(_all([F.col(name).isNotNull() for name in (*keys, "__at")]))
        .distinct()
    )
    known = dimension.select(
        *[F.col(target).alias(key) for key, (_, target) in zip(keys, pairs)],
        F.col("valid_from").alias("__at"),
        F.lit(0).alias("__kind"),
        quoted(HASH_COLUMN).alias("__tie"),
        quoted(surrogate).alias("__value"),
    ).filter(F.col("__at").isNotNull())
    nothing = F.lit(None).cast("string")
    timeline = known.unionByName(asked.withColumns({"__kind": F.lit(1), "__tie": nothing, "__value": nothing}))
    resolved = (
        last_seen(timeline, keys, ["__at", "__kind", "__tie"], "__value", "__found", slots)
        .filter((F.col("__kind") == 1) & F.col("__found").isNotNull())
        .select(*keys, "__at", "__found")
    )
    matched = [(source, key) for key, (source, _) in zip(keys, pairs)] + [(at, "__at")]
    return lookup(fact, stage(resolved, "resolved"), matched, "__found", output)


def build_fact(
    frame: DataFrame,
    fact: Fact,
    tables: Mapping[str, DataFrame],
    dimensions: Mapping[str, Dimension],
    slots: int | None = None,
) -> DataFrame:
    """Project the fact columns and look up every configured dimension in order.

    ``tables`` holds stored dimensions. With ``fan_out`` a join gives one row per matching member or version.
    """
    result = frame.select(*[column.column() for column in fact.columns])
    for join in fact.joins:
        dimension = dimensions[join.dimension]
        surrogate = dimension.surrogate_key
        output = join.output_key or surrogate
        if len(join.source_key) != len(join.target_key):
            raise ValueError("Join to {} needs as many source keys as target keys".format(join.dimension))
        if not join.fan_out and not join.finds_one(dimension):
            raise ValueError("Join to {} can multiply rows; set fan_out to allow it".format(join.dimension))
        pairs = list(zip(join.source_key, join.target_key))
        if join.effective_at and dimension.scd_type == 2:
            table, at = tables[join.dimension], join.effective_at
            if join.finds_one(dimension):
                result = lookup_sorted(result, table, pairs, at, surrogate, output, slots)
            else:
                result = lookup_valid(result, table, pairs, at, surrogate, output)
        else:
            result = lookup(result, tables[join.dimension], pairs, surrogate, output)
    return result
