"""Deterministic codes derived from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import suffixed, to_col

CODE_DIGITS = 10


def stable_code(c: Column | str) -> Column:
    """Ten-digit code: first 15 hex digits of SHA-256, modulo 10^10, zero-padded."""
    head = F.substring(F.sha2(to_col(c).cast("string"), 256), 1, 15)
    number = F.conv(head, 16, 10).cast("bigint") % F.lit(10**CODE_DIGITS)
    return F.lpad(number.cast("string"), CODE_DIGITS, "0")


def path_code(columns: list[Column], sep: str = "|", null_token: str | None = None) -> Column:
    """Code of a path of names.

    NULL names are skipped, so a path with a gap equals the shorter path;
    ``null_token`` keeps them apart.
    """
    if null_token is not None:
        columns = [F.coalesce(c, F.lit(null_token)) for c in columns]
    return stable_code(columns[0] if len(columns) == 1 else F.concat_ws(sep, *columns))


def crc_code(c: Column | str, suffix: str = "") -> Column:
    """Ten-digit CRC-32 of the text with a suffix."""
    return suffixed(F.lpad(F.crc32(to_col(c)).cast("string"), CODE_DIGITS, "0"), suffix)
