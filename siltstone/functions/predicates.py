"""Row predicates used by the filters, profiles and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name for use in an expression, dots and hyphens included."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string literal for use in an expression."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(name: str) -> Column:
    """A top-level column by its exact name."""
    return F.col(quoted(name))


def any_null(columns: Sequence[str]) -> Column:
    """True where at least one of ``columns`` is null."""
    return F.expr(" OR ".join(f"{quoted(c)} IS NULL" for c in columns) or "FALSE")


def blank(key: str) -> Column:
    """Null, empty or spaces only; ``trim`` leaves tabs, so a tab is a value."""
    return F.expr(f"{quoted(key)} IS NULL OR trim({quoted(key)}) = ''")


def negative(measure: str) -> Column:
    return F.expr(f"{quoted(measure)} < 0")


def zero(measure: str) -> Column:
    return F.expr(f"{quoted(measure)} = 0")


def broken_rule(key: str, measure: str) -> Column:
    """Blank key or a measure of zero or less.

    Three-valued: a null measure with a good key compares to null and so is
    not counted as broken.
    """
    return blank(key) | F.expr(f"{quoted(measure)} <= 0")


def null_names(columns: Sequence[str]) -> Column:
    """Array of the names of the null columns of a row, in column order."""
    flags = [f"IF({quoted(c)} IS NULL, {literal(c)}, NULL)" for c in columns]
    return F.expr(f"array_compact(array({', '.join(flags)}))")
