"""Text to numbers without exceptions: a bad value becomes NULL and never ends a stream."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DECIMAL = "decimal(24,4)"
# What may be cast at all. For any other text Spark raises and catches an exception per value, which
# costs a hundred times the pattern match and would let dirty input slow a stream down.
NUMERIC = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
WHOLE = r"^\s*[+-]?\d+\s*$"
# Surely fits the decimal type.
SHORT = r"^\s*[+-]?\d{1,19}(\.\d*)?\s*$"
# Such values within a pattern of many, which has to match without backtracking.
DIGITS = r"[+-]?\d{1,19}+(?:\.\d*+)?"


def record_pattern(policies: Sequence[str], separator: str, blanks: bool) -> str:
    """What records look like that surely hold readable numbers: values with these policies, one after the other.
    With ``blanks`` there may be white space around numbers, and nothing else where the policy lets that pass;
    without, each number is just digits. A record beside the pattern can still be readable."""
    number = rf"\s*+{DIGITS}\s*+" if blanks else DIGITS
    maybe = rf"\s*+(?:{DIGITS}\s*+)?+" if blanks else DIGITS
    shapes = {"text": rf"[^{separator}]*+", "strict": number}
    return rf"^{re.escape(separator).join(shapes.get(policy, maybe) for policy in policies)}\z"


def trimmed(text: Column) -> Column:
    """Without white space of any kind around it; stray line ends often cling to the last value."""
    return F.btrim(text, F.lit(" \t\n\r\x0b\x0c"))


def is_blank(text: Column) -> Column:
    return trimmed(text) == ""


def to_decimal(text: Column) -> Column:
    return F.when(text.rlike(NUMERIC), text.try_cast(DECIMAL))


def number_mark(text: Column) -> Column:
    """True for what :func:`to_decimal` can read, else NULL: cheaper where just that is asked."""
    return F.when(text.rlike(SHORT) | to_decimal(text).isNotNull(), F.lit(True))


def to_long(text: Column) -> Column:
    """Whole number, fraction cut off. Plain digits take the short way, the rest goes via decimal."""
    whole = F.when(text.rlike(WHOLE), text.try_cast("long"))
    return F.coalesce(whole, to_decimal(text).try_cast("long"))


def by_policy(text: Column, plain: Column, policy: str) -> Column:
    """``text`` keeps the string; ``strict`` gives NULL for blank or malformed input, ``zero``
    gives 0 for blank input, ``null`` gives NULL for blank input. ``plain`` says that a number is just digits."""
    if policy == "text":
        return text
    number = F.when(plain | text.rlike(NUMERIC), text.try_cast(DECIMAL))
    return number.when(is_blank(text), F.lit(0).cast(DECIMAL)) if policy == "zero" else number


def breaks_policy(text: Column, policy: Column) -> Column:
    """True where the value may not pass: blank only counts against ``strict``."""
    return (policy != "text") & number_mark(text).isNull() & ((policy == "strict") | ~is_blank(text))


def as_message_text(text: Column, plain: Column, policy: str) -> Column:
    """The value as it stands in a published message: digits as received, blanks by policy. ``plain`` says that
    a number is just digits."""
    if policy == "text":
        return text
    digits = trimmed(text)
    if policy == "zero":
        digits = F.when(is_blank(text), F.lit("0")).otherwise(digits)
    if policy == "null":
        digits = F.nullif(digits, F.lit(""))
    return F.when(plain, text).otherwise(digits)


def ratio(top: Column, bottom: Column) -> Column:
    """Division as double; NULL for a zero or missing divisor."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))
