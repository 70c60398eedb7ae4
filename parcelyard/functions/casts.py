"""String-to-type columns that turn bad input into null instead of failing.

None of them depends on the session time zone: timestamps stay zone-free.
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_DAY_OR_SECOND = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}:\d{2}(\.\d+)?)?$"


def clean_text(col: Column, ascii_only: bool = False) -> Column:
    """Trim spaces and lower-case; ``ascii_only`` leaves accented capitals alone."""
    trimmed = F.trim(col)
    if ascii_only:
        return F.translate(trimmed, string.ascii_uppercase, string.ascii_lowercase)
    return F.lower(trimmed)


def _whole_number(col: Column, sql_type: str, high: int) -> Column:
    number = F.trim(col).try_cast(sql_type)
    return F.when(number.between(0, high), number)


def to_uint8(col: Column) -> Column:
    """0..255 as a short, anything else null."""
    return _whole_number(col, "smallint", 255)


def to_uint32(col: Column) -> Column:
    """0..2**32-1 as a long, anything else null."""
    return _whole_number(col, "bigint", 2**32 - 1)


def to_double(col: Column) -> Column:
    """Plain or scientific decimal notation as a double.

    The pattern keeps out forms the cast alone would accept, such as ``1.5d``.
    """
    text = F.trim(col)
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def to_second(col: Column) -> Column:
    """``yyyy-MM-dd[ HH:mm:ss[.f]]`` as a zone-free timestamp, fraction dropped.

    The pattern keeps out a bare year, which the cast alone would accept.
    """
    text = F.trim(col)
    return F.when(
        text.rlike(_DAY_OR_SECOND), F.substring(text, 1, 19).try_cast("timestamp_ntz")
    )
