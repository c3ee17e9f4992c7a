"""Safe text -> int cast.

Under ANSI a direct ``cast('NA' as int)`` raises and ``try_cast('12.5' as
int)`` gives null; the rule wanted is null for bad text and truncation for
decimals, so the text goes through double first."""

from __future__ import annotations

from pyspark.sql import Column


def text_to_int(c: Column) -> Column:
    return c.try_cast("double").try_cast("int")
