"""Small helpers for naming columns and building order keys."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(name: str) -> Column:
    """A column by its literal name; dots and commas in the name are not special."""
    return F.col("`" + name.replace("`", "``") + "`")


def cols(names: Iterable[str]) -> list[Column]:
    return [col(n) for n in names]


def entry(names: Sequence[str]) -> Column:
    """A struct of the named columns, compared field by field."""
    return F.struct(*cols(names))


def ascending(names: Sequence[str]) -> list[Column]:
    """Ascending sort keys with nulls last."""
    return [col(n).asc_nulls_last() for n in names]


def others(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Columns of ``df`` not listed in ``names``, in table order."""
    known = set(names)
    return [c for c in df.columns if c not in known]


def required(value: Column, message: str) -> Column:
    """``value``; a null stops the job with ``message``."""
    return F.coalesce(value, F.raise_error(F.lit(message)))


def same_keys(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    """Equality on all ``names`` in which null equals null."""
    condition = F.lit(True)
    for n in names:
        quoted = "`" + n.replace("`", "``") + "`"
        condition = condition & left[quoted].eqNullSafe(right[quoted])
    return condition


def earliest(names: Sequence[str]) -> Column:
    """Aggregate: the least order key, as a struct of the named columns.

    One column is aggregated bare, which keeps the hash aggregate.
    """
    if len(names) == 1:
        return F.struct(F.min(col(names[0])).alias(names[0]))
    return F.min(entry(names))
