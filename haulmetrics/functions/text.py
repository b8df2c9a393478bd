"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from haulmetrics.functions.numeric import as_col


#: White space of Unicode, and the four separators that Python strips as well.
BLANKS = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
                           *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(value: Column | str) -> Column:
    """Drop leading and trailing white space of any kind (``trim`` drops blanks only)."""
    return F.btrim(as_col(value), F.lit(BLANKS))


def title(value: Column | str) -> Column:
    return F.initcap(as_col(value))


def digits_only(value: Column | str) -> Column:
    return F.regexp_replace(as_col(value), r"\D", "")


def header_key(name: str) -> str:
    """Header text reduced to lower-case letters and digits."""
    return "".join(ch for ch in name.lower() if ch.isalnum())


def prefixed(prefix: str, value: Column | str, length: int | None = None) -> Column:
    value = as_col(value)
    return F.concat(F.lit(prefix), value if length is None else F.substring(value, 1, length))


def packed(value: Column | str) -> Column:
    """Text as bytes of which lower-case hex takes half; the first byte tells which it is."""
    value = as_col(value)
    digits = F.unhex(value)
    return (F.when(F.lower(F.hex(digits)) == value, F.concat(F.lit(b"\x01"), digits))
            .otherwise(F.concat(F.lit(b"\x00"), value.cast("binary"))))


def unpacked(value: Column | str) -> Column:
    """The text that ``packed`` took."""
    value = as_col(value)
    rest = F.substring(value, 2, 2 ** 31 - 1)
    return F.when(F.substring(value, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(rest))).otherwise(
        rest.cast("string"))


def mentions(value: Column | str, word: str) -> Column:
    """True when the text holds ``word`` in any case; missing text is false."""
    return F.coalesce(F.lower(as_col(value)).contains(word.lower()), F.lit(False))
