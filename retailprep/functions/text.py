"""Column functions for raw text: blanks, numbers, dates, names."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The date shapes price files carry, in order of preference.
DATE_FORMATS = ("yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "dd.MM.yyyy")


def to_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.trim(to_col(c)), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """True for NULL, empty and all-blank text; never NULL."""
    return blank_to_null(c).isNull()


def parse_decimal(c: Column | str, precision: int, scale: int, strict: bool = False) -> Column:
    """Local decimal text as DECIMAL(precision, scale); what does not parse is NULL.

    By default everything but digits, comma, point and minus is dropped, so
    currency suffixes and blank thousands separators are accepted.  ``strict``
    drops only quotes: an inner blank then makes the value NULL, while
    scientific notation is read as such.  Digits beyond ``scale`` round half up.
    """
    text = to_col(c)
    digits = F.translate(text, '"', "") if strict else F.regexp_replace(text, r"[^0-9,.\-]", "")
    return F.translate(digits, ",", ".").try_cast(f"decimal({precision},{scale})")


# Formats whose every letter is a digit of the text.
FIXED_WIDTH = re.compile("([yMdHms]+|[ .:/-])+")


def parse_date(c: Column | str, formats: Sequence[str] | None = None) -> Column:
    """Date from the first matching format; without formats, from ISO text.

    Text is only parsed by a fixed-width format whose shape it has: parsing what
    does not fit would raise and catch an exception for every row.  Year, month
    and day of such a shape are read as ISO text, without a formatter.
    """
    text = to_col(c)
    if formats is None:
        return text.try_cast("date")
    return F.coalesce(*[F.when(text.rlike(_shape(f)), _dated(text, f)) for f in formats])


# What the letters of a format may be, where not any two digits.
DIGITS = {"yyyy": r"\d{4}", "HH": r"(?:[01]\d|2[0-3])", "mm": r"[0-5]\d", "ss": r"[0-5]\d"}
PARTS = re.compile("yyyy|MM|dd|HH|mm|ss")


def _in_parts(date_format: str) -> bool:
    """Whether a format is made of a year, a month, a day and perhaps a time, each once in full width, and separators."""
    parts = PARTS.findall(date_format)
    plain = re.fullmatch("[ .:/-]*", PARTS.sub("", date_format)) is not None
    return plain and len(set(parts)) == len(parts) and {"yyyy", "MM", "dd"} <= set(parts)


def _dated(text: Column, date_format: str) -> Column:
    """Date of a text that has the shape of the format."""
    if not _in_parts(date_format):
        return F.try_to_date(text, date_format)
    if date_format.startswith("yyyy-MM-dd"):
        return F.substring(text, 1, 10).try_cast("date")
    parts = [F.substring(text, date_format.index(p) + 1, len(p)) for p in ("yyyy", "MM", "dd")]
    return F.concat_ws("-", *parts).try_cast("date")


def _shape(date_format: str) -> str:
    """Pattern of the texts a format may fit: its letters are digits; any text unless its width is fixed."""
    if not FIXED_WIDTH.fullmatch(date_format):
        return "(?s).*"
    if _in_parts(date_format):
        shape = PARTS.sub(lambda part: DIGITS.get(part[0], r"\d\d"), re.sub("[ .:/-]", lambda mark: f"[{mark[0]}]", date_format))
        return rf"\A{shape}\z"
    digits = re.sub("[a-zA-Z]", lambda _: r"\d", re.escape(date_format))
    return rf"\A{digits}\z"


def strip_last(c: Column | str) -> Column:
    """Trimmed text without its last character (price zone to market zone)."""
    text = F.trim(to_col(c))
    return F.substring(text, F.lit(1), F.length(text) - 1)


def map_value(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """Value from a literal mapping, the input itself where it has no entry."""
    key = to_col(c)
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), key) if pairs else key


def suffixed(c: Column | str, suffix: str) -> Column:
    return F.concat(to_col(c), F.lit(suffix))


def sku(a: Column | str, b: Column | str) -> Column:
    """``a_b``; NULL if either part is NULL."""
    return F.concat(to_col(a), F.lit("_"), to_col(b))


def split_variant(c: Column | str, sep: str = "/") -> tuple[Column, Column]:
    """(parent code, size) of a variant code; size is NULL without separator."""
    text = F.trim(to_col(c))
    at = F.instr(text, F.lit(sep))
    parent = F.substring_index(text, sep, 1)
    size = F.when(at > 0, F.substring(text, at + len(sep), F.length(text)))
    return parent, size
