"""Column expressions on cells: text lists, periods, ids.  Built-ins only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fitweave.columns import required

# White space that stripping removes, including the four
# separator controls and the no-break space.
BLANKS = r"[\s\x1c-\x1f]"

# The marker of an empty place in a joined cell.
EMPTY_MARK = "*"


def stripped(value: Column) -> Column:
    """Text without leading and trailing white space of any kind."""
    return F.regexp_replace(value, f"(?U)^{BLANKS}+|{BLANKS}+$", "")


def empty_as_null(value: Column) -> Column:
    """What an empty cell becomes after a trip through a file."""
    return F.nullif(value, F.lit(""))


def members_with_prefix(
    value: Column, prefix: str, but_not: tuple[str, ...] = (), joiner: str = ", "
) -> Column:
    """Members of a text list that start with ``prefix``, trimmed and re-joined.

    A null cell, or one without such members, gives empty text.
    """

    def wanted(member: Column) -> Column:
        keep = member.startswith(prefix)
        for other in but_not:
            keep = keep & ~member.startswith(other)
        return keep

    members = F.transform(F.split(F.coalesce(value, F.lit("")), ","), stripped)
    return F.array_join(F.filter(members, wanted), joiner)


def without_marks(value: Column) -> Column:
    """Drop empty-place marks and the commas next to them from a joined cell."""
    mark = EMPTY_MARK
    for text in (mark + ",", "," + mark, mark):
        value = F.replace(value, F.lit(text), F.lit(""))
    return value


def member_count(value: Column) -> Column:
    return F.size(F.split(value, ","))


def distinct_member_count(value: Column) -> Column:
    return F.size(F.array_distinct(F.split(value, ",")))


def list_text(values: Column) -> Column:
    """An array as one text cell, ``[1, 2]``; a null member reads ``nan``."""
    shown = F.transform(values, lambda v: F.coalesce(v.cast("string"), F.lit("nan")))
    return F.concat(F.lit("["), F.array_join(shown, ", "), F.lit("]"))


def id_text(value: Column) -> Column:
    """A numeric id as integer text, truncated toward zero; empty when missing."""
    present = value.isNotNull() & ~F.isnan(value.cast("double"))
    return F.coalesce(F.when(present, value).cast("bigint").cast("string"), F.lit(""))


def period_bounds(period: Column) -> tuple[Column, Column]:
    """Start and end text of ``start-end``, either of them possibly empty.

    Without a dash both are the whole text; a null or a second dash is an error.
    """
    period = required(period, "a period is missing")
    parts = F.split(period, "-")
    checked = F.when(F.size(parts) <= 2, parts).otherwise(
        F.raise_error(F.concat(F.lit("not a period: "), period))
    )
    return F.get(checked, 0), F.coalesce(F.get(checked, 1), period)


def month_text(month: Column) -> Column:
    """``YYYYMM`` as ``MM.YYYY``, by position from the end."""
    return F.concat(
        F.substring(month, -2, 2),
        F.lit("."),
        F.left(month, F.greatest(F.length(month) - 2, F.lit(0))),
    )


def model_text(model: Column, start: Column, end: Column) -> Column:
    return F.concat(model, F.lit(" "), month_text(start), F.lit("-"), month_text(end))
