from .codes import crc_code, path_code, stable_code
from .retail import (
    CLOSED,
    COUNTRY_ALIASES,
    COUNTRY_NAMES,
    ONLINE,
    flag_differs,
    flag_equals,
    is_old_season,
    level5_name,
    market_code,
    normalise_country,
    season_year,
    signed,
)
from .text import (
    DATE_FORMATS,
    blank_to_null,
    is_blank,
    map_value,
    parse_date,
    parse_decimal,
    sku,
    split_variant,
    strip_last,
    suffixed,
    to_col,
)

__all__ = [
    "CLOSED",
    "COUNTRY_ALIASES",
    "COUNTRY_NAMES",
    "DATE_FORMATS",
    "ONLINE",
    "blank_to_null",
    "crc_code",
    "flag_differs",
    "flag_equals",
    "is_blank",
    "is_old_season",
    "level5_name",
    "map_value",
    "market_code",
    "normalise_country",
    "parse_date",
    "parse_decimal",
    "path_code",
    "season_year",
    "signed",
    "sku",
    "split_variant",
    "stable_code",
    "strip_last",
    "suffixed",
    "to_col",
]
