"""Text cell repair (all plain column expressions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as K


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


#: What the bytes 0x80-0x9F stand for in Windows-1252 (five stand for nothing), and the characters that a Latin-1 scan makes of them.
_CODE_PAGE = [(chr(b), bytes([b]).decode("cp1252")) for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]


def from_code_page(c: Column | str) -> Column:
    """Windows-1252 text from text scanned as ISO-8859-1: the two differ in 27 characters alone."""
    return F.translate(_c(c), "".join(a for a, _ in _CODE_PAGE), "".join(b for _, b in _CODE_PAGE))


def normalize(c: Column | str) -> Column:
    """Lower-case and strip surrounding whitespace (any kind, not only spaces)."""
    return F.lower(F.regexp_replace(_c(c), r"^\s+|\s+$", ""))


def blank_to(c: Column | str, default: str) -> Column:
    """Blank text -> ``default``; null stays null."""
    c = _c(c)
    return F.when(F.length(c) == 0, F.lit(default)).otherwise(c)


def overlong_to(c: Column | str, max_len: int, default: str) -> Column:
    """Text longer than ``max_len`` characters -> ``default``."""
    c = _c(c)
    return F.when(F.length(c) > max_len, F.lit(default)).otherwise(c)


def blank_to_null(c: Column | str) -> Column:
    c = _c(c)
    return F.when(c == "", F.lit(None).cast("string")).otherwise(c)


def missing_to(c: Column | str, default: str) -> Column:
    """Null or blank -> ``default``."""
    return F.coalesce(blank_to_null(c), F.lit(default))


#: :func:`na_level` as SQL text of a column name ``c``, for selects of hundreds of columns.
NA_LEVEL_SQL = "coalesce(`{c}`, '" + K.NA_LEVEL + "')"


def na_level(c: Column | str) -> Column:
    """Missing categorical value as its own level."""
    return F.coalesce(_c(c), F.lit(K.NA_LEVEL))


def pad_if_length(c: Column | str, length: int, width: int = 5, fill: str = "0") -> Column:
    """Left-pad to ``width`` when the text is exactly ``length`` long."""
    c = _c(c)
    return F.when(F.length(c) == length, F.lpad(c, width, fill)).otherwise(c)


def pad_if_shorter(c: Column | str, width: int = 5, fill: str = "0") -> Column:
    c = _c(c)
    return F.when(F.length(c) < width, F.lpad(c, width, fill)).otherwise(c)


def trim_plus4(c: Column | str, length: int = 10) -> Column:
    """ZIP+4 (``12345-6789``) -> the part before the first hyphen."""
    c = _c(c)
    return F.when(F.length(c) == length, F.substring_index(c, "-", 1)).otherwise(c)


def has_letters(c: Column | str) -> Column:
    return _c(c).rlike("[A-Za-z]")


def is_domestic(c: Column | str) -> Column:
    """1.0 unless the postcode holds a letter (foreign code); blank/null -> 1."""
    return F.when(F.coalesce(has_letters(c), F.lit(False)), F.lit(0.0)).otherwise(F.lit(1.0))


def foreign_bin(c: Column | str) -> Column:
    return F.when(F.coalesce(has_letters(c), F.lit(False)), F.lit("foreign")).otherwise(F.lit(""))


def both_missing(a: Column | str, b: Column | str) -> Column:
    return (_c(a).isNull() & _c(b).isNull()).cast("double")
