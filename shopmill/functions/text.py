"""Text helpers: blanks and comma-separated addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def filled(column: Column) -> Column:
    """Not NULL and not only blanks."""
    return column.isNotNull() & (F.trim(column) != "")


def address_head(address: Column) -> Column:
    """First comma-separated part, trimmed."""
    return _part(address, 1, 1)


def address_part(address: Column, back: int) -> Column:
    """Part number ``count - back``, counted from 1, trimmed.

    Position 0 gives '', and a negative position counts from the end: with two
    parts, ``back=3`` is position -1, the last part. Out of range gives ''.

    Written with ``substring_index``, which scans the text without making an
    array; an optimizer that copies the expression into a filter stays cheap.
    """
    cases = F.when(_has_commas(address, back), _part(address, -(back + 1), 1))
    for commas in reversed(range(back)):
        wrapped = 2 * commas + 2 - back  # counted from 0
        inside = wrapped >= 0 and commas != back - 1
        value = _part(address, wrapped + 1, -1) if inside else F.lit("")
        cases = cases.when(_has_commas(address, commas), value)
    return cases


def _has_commas(address: Column, at_least: int) -> Column:
    if at_least == 0:
        return address.isNotNull()
    return F.substring_index(address, ",", at_least) != address


def _part(address: Column, outer: int, inner: int) -> Column:
    return F.trim(F.substring_index(F.substring_index(address, ",", outer), ",", inner))


def place_text(address: Column) -> Column:
    """The last three parts, which alone decide ``address_part`` up to ``back=2``."""
    return F.substring_index(address, ",", -3)


def has_parts(address: Column) -> Column:
    return F.instr(address, ",") > 0
