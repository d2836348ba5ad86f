"""Column functions with retail meaning."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, to_col

# Fixed values of the store feed.
ONLINE = "Eshop"
CLOSED = "ZAMKNIETE"
COUNTRY_ALIASES = {"PO": "PL", "SV": "SK"}
COUNTRY_NAMES = {
    "PL": "Polska",
    "LT": "Litwa",
    "HR": "Chorwacja",
    "CZ": "Czechy",
    "SK": "Slowacja",
    "DE": "Niemcy",
    "AT": "Austria",
    "HU": "Wegry",
    "RO": "Rumunia",
    "UA": "Ukraina",
    "BG": "Bulgaria",
    "SI": "Slowenia",
    "EE": "Estonia",
    "LV": "Lotwa",
    "RS": "Serbia",
    "Eshop": "Eshop",
}

# Fixed value: season codes that carry a year, e.g. SS26 or AW25.
SEASON_PATTERN = r"^(SS|AW)(\d{2})$"


def normalise_country(
    c: Column | str,
    aliases: Mapping[str, str] = COUNTRY_ALIASES,
    blank: str = ONLINE,
) -> Column:
    """Two-letter upper-case country; blank text becomes ``blank``."""
    code = F.substring(F.upper(blank_to_null(c)), 1, 2)
    out = F.when(code.isNull(), F.lit(blank))
    for old, new in aliases.items():
        out = out.when(code == old, F.lit(new))
    return out.otherwise(code)


def flag_equals(c: Column | str, value: str) -> Column:
    """1 where equal, else 0; NULL counts as not equal."""
    return F.when(to_col(c) == value, 1).otherwise(0)


def flag_differs(c: Column | str, value: str) -> Column:
    """1 where different, else 0; NULL counts as not different."""
    return F.when(to_col(c) != value, 1).otherwise(0)


def season_year(c: Column | str) -> Column:
    """Four-digit year of a dated season code, NULL for evergreen ones."""
    digits = F.regexp_extract(F.upper(F.trim(to_col(c))), SEASON_PATTERN, 2)
    return F.lit(2000) + digits.try_cast("int")


def is_old_season(c: Column | str, year: int, back: int = 1) -> Column:
    """True for seasons before ``year - back``; evergreen seasons are never old."""
    return F.coalesce(season_year(c) < year - back, F.lit(False))


def level5_name(attribute: Column | str | None, level4: Column | str) -> Column:
    """Attribute and level-4 description joined by a blank; NULLs are skipped."""
    parts = [] if attribute is None else [F.trim(to_col(attribute))]
    return F.concat_ws(" ", *parts, F.trim(to_col(level4)))


def signed(c: Column | str, is_return: Column) -> Column:
    """The value with its sign flipped on returns."""
    return F.when(is_return, -to_col(c)).otherwise(to_col(c))


def market_code(store: Column | str, country: Column | str, online: Sequence[str]) -> Column:
    """Online market for listed stores, else the country."""
    return F.when(to_col(store).isin(list(online)), F.lit(ONLINE)).otherwise(to_col(country))
