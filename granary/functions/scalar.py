"""Column expressions with the retail feed's exact rules."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"\A[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"
DAY = r"\A[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}\z"


def snake(name: str) -> str:
    """PO_ID → po_id, IsWeekend → is_weekend, MOQ → moq."""
    words = re.sub(r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])", "_", re.sub(r"[- ]", "_", name))
    return re.sub(r"_+", "_", words).casefold()


def blank(c: Column) -> Column:
    """Null or nothing but white space of any kind."""
    return c.isNull() | c.cast("string").rlike(r"(?U)\A\s*\z")


def trimmed(c: Column) -> Column:
    """Without spaces around (spaces only); null if nothing is left."""
    return F.nullif(F.trim(c), F.lit(""))


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; null where b is null or zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def same(a: Column, b: Column) -> Column:
    """Equality under which nulls are equal; never null."""
    return a.eqNullSafe(b)


def matches(c: Column, pattern: str) -> Column:
    """Whether the whole value matches."""
    return c.rlike(rf"\A(?:{pattern})\z")


def strict(c: Column, logical: str) -> Column:
    """Text to its logical type; null where the text isn't strictly of it.

    Numbers may have white space around, a sign, a fraction and an exponent, and must be finite; integers may be
    written with a zero fraction. Days are year-month-day with one or two digits for month and day. Truth values are
    True and False, in just this case.
    """
    if logical == "string":
        return c
    if logical == "boolean":
        return F.when(c == "True", F.lit(True)).when(c == "False", F.lit(False))
    if logical == "date":
        padded = F.regexp_replace(F.regexp_replace(c, r"-([0-9])-", "-0$1-"), r"-([0-9])\z", "-0$1")
        return F.when(c.rlike(DAY), padded.try_cast("date"))
    number = F.trim(F.regexp_replace(c, r"(?U)\A\s+|\s+\z", ""))
    value = F.when(number.rlike(NUMBER), number.try_cast("double"))
    value = F.when(F.abs(value) < float("inf"), value)
    if logical == "decimal":
        return value
    # 19-digit integers lose digits as doubles, so plain ones are cast from their text
    plain = F.when(number.rlike(r"\A[+-]?[0-9]+\z"), number.try_cast("bigint"))
    return F.coalesce(plain, F.when((value % 1 == 0) & (F.abs(value) < 2.0**63), value.cast("bigint")))
