"""Columns that an operator does not read, kept out of the way of its own names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from fitweave.columns import col


def set_apart(df: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The table with all but the needed columns renamed, and a function that selects the given ones again."""
    names = {c: c if c in needed else f"_apart_{i}" for i, c in enumerate(df.columns)}
    renamed = df.select(*[col(c).alias(n) for c, n in names.items()])

    def back(result: DataFrame) -> DataFrame:
        return result.select(*[col(n).alias(c) for c, n in names.items()])

    return renamed, back
