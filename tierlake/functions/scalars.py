"""Scalar expressions. All of them are built-in Spark functions, so they stay inside code generation."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, functions as F

# Whole-number type names of Spark SQL.
INTEGRAL_TYPES = ("tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long")
HASH_SEPARATOR = "||"


def quoted(name: str) -> Column:
    """A column by its exact name, also when the name holds dots or spaces."""
    return F.col("`{}`".format(name.replace("`", "``")))


def spark_type(type_name: str) -> str:
    """Config type name to Spark type. Every Spark DDL type name is accepted as it is."""
    name = type_name.strip()
    return "int" if name.lower() == "integer" else name


def blank_to_null(column: Column) -> Column:
    """NULL for text made of nothing but spaces; other values keep their spaces."""
    return F.when(F.trim(column.cast("string")) == "", None).otherwise(column)


def typed_cast(column: Column, type_name: str, from_text: bool = True) -> Column:
    """Cast that gives NULL for a value that does not fit, whatever the session's ANSI setting is.

    Whole-number targets also take decimal text and drop the fraction (``'12.7'`` is 12, ``'.5'`` is 0,
    ``'1e3'`` is NULL). The plain cast comes first, so the text functions only run on values it refuses.
    """
    target = spark_type(type_name)
    direct = column.try_cast(target)
    if not from_text or target.lower() not in INTEGRAL_TYPES:
        return direct
    trailing = r"[\x00-\x20]*$"
    with_digit = F.regexp_replace(F.trim(column), r"(?<![0-9])\.[0-9]*" + trailing, "0")
    whole = F.regexp_replace(with_digit, r"\.[0-9]*" + trailing, "")
    return F.coalesce(direct, whole.try_cast(target))


def typed_literal(value: Any, type_name: str) -> Column:
    """A constant in the declared type, so that it never widens the column it is compared or merged with."""
    return F.lit(value).cast(spark_type(type_name))


def fill_null(column: Column, value: Any, type_name: str) -> Column:
    """Replace NULL by a constant of the declared type."""
    return F.coalesce(column, typed_literal(value, type_name))


def hash_key(names: Iterable[str], null_token: str | None = None) -> Column:
    """SHA-256 over the text of the columns, joined by a separator.

    NULLs leave no trace in the text, so (a, NULL, b) and (a, b, NULL) get the same key. Give ``null_token`` to
    keep such rows apart; keys made with and without it are not comparable.
    """
    parts = [quoted(name).cast("string") for name in names]
    if null_token is not None:
        parts = [F.coalesce(part, F.lit(null_token)) for part in parts]
    return F.sha2(F.concat_ws(HASH_SEPARATOR, *parts), 256)
