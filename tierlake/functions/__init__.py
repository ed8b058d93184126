"""Column-level building blocks."""

from tierlake.functions.scalars import (
    blank_to_null,
    fill_null,
    hash_key,
    spark_type,
    typed_cast,
    typed_literal,
)

__all__ = ["blank_to_null", "fill_null", "hash_key", "spark_type", "typed_cast", "typed_literal"]
