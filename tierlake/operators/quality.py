"""Declarative quality rules: typed columns, one check code per ruled column, clean and rejected rows.

Everything here is a projection or a filter: no shuffle, no Python, one pass over the input per written result.
Check codes are small integers; the readable reason text is only built for rejected rows.

The row counts are observed between the checks and the split. That saves counting jobs, and it keeps Catalyst from
pushing the split filter through the casts, which would evaluate every cast several times per row.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from tierlake.functions.scalars import blank_to_null, fill_null, quoted, typed_cast, typed_literal

# Reason texts by check code (1-based), in order of precedence.
REASONS = (
    ("unexpected_value", "cast_failed"),
    ("unexpected_null", "required_field_missing"),
    ("unexpected_value", "below_minimum"),
    ("unexpected_value", "above_maximum"),
    ("unexpected_value", "not_accepted"),
)
CAST_FAILED, MISSING, BELOW, ABOVE, NOT_ACCEPTED = range(1, 6)

_SOURCE = "__text_"
_CHECK = "__check_"
NO_FILL = object()
# Types whose text form is never blank.
_NEVER_BLANK = (T.NumericType, T.DatetimeType, T.BooleanType)


@dataclass(frozen=True)
class ColumnRule:
    """What a column must look like. ``required`` is true when the null check is on and the column is critical."""

    name: str
    type: str = "string"
    required: bool = False
    minimum: Any = None
    maximum: Any = None
    accepted: tuple = ()
    fill: Any = NO_FILL

    @property
    def can_fail(self) -> bool:
        return (
            self.type.lower() != "string"
            or self.required
            or self.minimum is not None
            or self.maximum is not None
            or bool(self.accepted)
        )


def _check_code(source: Column, value: Column, rule: ColumnRule) -> Column:
    code = F.when(source.isNotNull() & value.isNull(), F.lit(CAST_FAILED))
    if rule.required:
        code = code.when(source.isNull(), F.lit(MISSING))
    if rule.minimum is not None:
        code = code.when(value < F.lit(rule.minimum), F.lit(BELOW))
    if rule.maximum is not None:
        code = code.when(value > F.lit(rule.maximum), F.lit(ABOVE))
    if rule.accepted:
        accepted = [typed_literal(item, rule.type) for item in rule.accepted]
        code = code.when(value.isNotNull() & ~value.isin(*accepted), F.lit(NOT_ACCEPTED))
    return code


def _failed(ruled: Sequence[str]) -> Column:
    if not ruled:
        return F.lit(False)
    return F.coalesce(*[quoted(_CHECK + name) for name in ruled]).isNotNull()


@dataclass(frozen=True)
class Evaluated:
    """A checked frame: typed and filled columns followed by helper columns with check codes and original text."""

    frame: DataFrame
    columns: tuple[str, ...]
    ruled: tuple[str, ...]
    keep_source: bool

    @property
    def failed(self) -> Column:
        """True for a row with at least one failing column."""
        return _failed(self.ruled)

    def valid(self) -> DataFrame:
        """Rows that pass every check, with the input's columns in the input's order."""
        return self.frame.filter(~self.failed).select(*[quoted(name) for name in self.columns])

    def rejected(self) -> DataFrame:
        """Rows that fail, with reasons, failing fields, stage and time.

        Columns hold the typed and filled values. With ``keep_source`` a map keeps the original text of the failing
        fields as well.
        """
        reasons, fields = [], []
        for name in self.ruled:
            code = quoted(_CHECK + name)
            texts = F.array(
                *[F.lit("field={}; check={}; reason={}".format(name, check, reason)) for check, reason in REASONS]
            )
            reasons.append(F.get(texts, code - 1))
            fields.append(F.when(code.isNotNull(), F.lit(name)))
        none = F.lit(None).cast("string")
        added = [
            F.concat_ws("; ", *(reasons or [none])).alias("rejection_reason"),
            F.concat_ws(",", *(fields or [none])).alias("rejected_fields"),
            F.lit("tech").alias("rejection_stage"),
            F.current_timestamp().alias("rejected_at"),
        ]
        if self.keep_source:
            pairs = [
                F.when(
                    quoted(_CHECK + name).isNotNull(),
                    F.struct(F.lit(name).alias("key"), quoted(_SOURCE + name).cast("string").alias("value")),
                )
                for name in self.ruled
            ]
            kept = F.map_from_entries(F.array_compact(F.array(*pairs))) if pairs else F.lit(None)
            added.append(kept.cast("map<string,string>").alias("source_values"))
        return self.frame.filter(self.failed).select(*[quoted(name) for name in self.columns], *added)


def evaluate(
    frame: DataFrame,
    rules: Sequence[ColumnRule],
    require_columns: bool = False,
    keep_source: bool = False,
    observation: Observation | None = None,
) -> Evaluated:
    """Type and check every column of the frame.

    Columns without a rule become text. Rules for columns the frame lacks are skipped unless ``require_columns`` is
    set: then a missing column arrives as NULL, so a required one rejects its rows. Checks look at the typed value
    before NULLs are filled, so filling never saves a required field. After the first action over the result,
    ``observation`` holds ``valid_rows`` and ``rejected_rows``. The observation also stops column pruning, so select
    the columns that matter first.
    """
    by_name = {rule.name: rule for rule in rules}
    present = {name.lower() for name in frame.columns}
    if require_columns:
        absent = [rule for rule in rules if rule.name.lower() not in present]
        frame = frame.select("*", *[F.lit(None).cast("string").alias(rule.name) for rule in absent])

    names = frame.columns
    types = {field.name: field.dataType for field in frame.schema.fields}
    is_text = {name: isinstance(kind, T.StringType) for name, kind in types.items()}
    applied = [by_name.get(name, ColumnRule(name)) for name in names]
    ruled = [rule for rule in applied if rule.can_fail]

    blanked = frame.select(
        *[
            (quoted(name) if isinstance(types[name], _NEVER_BLANK) else blank_to_null(quoted(name))).alias(
                _SOURCE + name
            )
            for name in names
        ]
    )
    typed = blanked.select(
        *[typed_cast(quoted(_SOURCE + rule.name), rule.type, is_text[rule.name]).alias(rule.name) for rule in applied],
        *[quoted(_SOURCE + rule.name) for rule in ruled],
    )
    kept_sources = [quoted(_SOURCE + rule.name) for rule in ruled] if keep_source else []
    checked = typed.select(
        *[
            (
                quoted(rule.name) if rule.fill is NO_FILL else fill_null(quoted(rule.name), rule.fill, rule.type)
            ).alias(rule.name)
            for rule in applied
        ],
        *[
            _check_code(quoted(_SOURCE + rule.name), quoted(rule.name), rule).alias(_CHECK + rule.name)
            for rule in ruled
        ],
        *kept_sources,
    )
    ruled_names = tuple(rule.name for rule in ruled)
    failed = _failed(ruled_names)
    observed = checked.observe(
        observation or "quality-{}".format(uuid.uuid4().hex),
        F.count(F.when(~failed, 1)).alias("valid_rows"),
        F.count(F.when(failed, 1)).alias("rejected_rows"),
    )
    return Evaluated(observed, tuple(names), ruled_names, keep_source)


def split(frame: DataFrame, rules: Sequence[ColumnRule], **options: bool) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected rows."""
    evaluated = evaluate(frame, rules, **options)
    return evaluated.valid(), evaluated.rejected()
