"""Column-expression builders for text work.

Python and Java regexes differ in three places that matter here
(SURVEY §1.4): ``\\s`` and ``strip()`` are Unicode-aware in Python, ``.``
stops only at ``\\n`` in Python, and a failed match is ``None`` in Python
but ``''`` from ``regexp_extract``. The helpers below pin the Python
behaviour with ``(?U)``, ``(?d)`` and ``nullif``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: Unicode whitespace at both ends."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def collapse_ws(c) -> Column:
    """Python ``re.sub(r'\\s+', ' ', s)``."""
    return F.regexp_replace(col(c), r"(?U)\s+", " ")


def extract_or_null(c, pattern: str, group: int = 1) -> Column:
    """First match group or NULL when the pattern does not match."""
    c = col(c)
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def utf8_len(c) -> Column:
    return F.octet_length(col(c))


def utf8_byte_ids(c) -> Column:
    """UTF-8 bytes of a string as ``ARRAY<INT>`` (values 0-255), JVM side.

    The UTF-8 bytes are re-read as ISO-8859-1, where every byte is exactly
    one character with that code point, so ``split`` + ``ascii`` yields the
    byte values without regexes or base conversion.
    """
    latin = F.decode(F.encode(col(c), "UTF-8"), "ISO-8859-1")
    return F.when(F.length(latin) == 0, F.array().cast("array<int>")).otherwise(
        F.transform(F.split(latin, ""), lambda ch: F.ascii(ch)))


def count_occurrences(c, sub) -> Column:
    """Non-overlapping occurrences of ``sub`` (Python ``str.count``)."""
    c, sub = col(c), col(sub) if not isinstance(sub, str) else F.lit(sub)
    return F.when(F.length(sub) == 0, F.length(c) + 1).otherwise(
        ((F.length(c) - F.length(F.replace(c, sub, F.lit("")))) / F.length(sub)).cast("long"))
