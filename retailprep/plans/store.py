"""Store master data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.retail import (
    CLOSED,
    COUNTRY_NAMES,
    ONLINE,
    flag_differs,
    flag_equals,
    normalise_country,
)
from ..functions.text import blank_to_null, map_value, strip_last
from ..operators.attributes import hierarchy
from ..operators.enrich import exclude_value, fill_from, lookup_fill, override
from ..operators.keys import latest_by
from ..operators.quality import Check, blank_check, quality_report, require_keys, store_stats
from ..operators.schema import Spec, check_columns, conform
from ..sources.read import find_column, with_columns_or_null

# Fixed values of the contract.
REQUIRED = ("store_code", "store_description")

# Target columns of the store feed.
STORE = Spec(
    columns={
        "external_id": "string",
        "code": "string",
        "name": "string",
        "country_symbol": "string",
        "market_code": "string",
        "sales_channel_code": "string",
        "opening_date": "date",
        "closing_date": "date",
        "is_active": "int",
        "is_closed": "int",
        "surface_area": "decimal(15,2)",
        "city_name": "string",
        "zip_code": "string",
        "longitude": "decimal(13,6)",
        "latitude": "decimal(13,6)",
        "channel_type": "string",
        "local_currency": "string",
        "first_price": "string",
        "actual_price": "string",
        "segment": "string",
        "community_id": "int",
        "category_level1_name": "string",
        "category_level1_code": "string",
        "category_level2_name": "string",
        "category_level2_code": "string",
        "category_level3_name": "string",
        "category_level3_code": "string",
        "category_level4_name": "string",
        "category_level4_code": "string",
    },
    mapping={
        "external_id": "store_code",
        "code": "store_code",
        "name": "store_description",
        "country_symbol": "country",
        "market_code": "market_zone",
        "sales_channel_code": "building_type",
        "surface_area": "gross_area",
        "city_name": "city",
        "zip_code": "zip",
    },
    # one column per department: men, women, junior, accessories, shoes
    optional={f"mos_attribute_{i}": "string" for i in range(1, 6)},
)


def newest_calendar(calendar: DataFrame) -> DataFrame:
    """The newest opening per store; equal openings are settled by the earliest closing."""
    return latest_by(calendar, ["store_code"], "opening_date", [F.col("closing_date").asc_nulls_last()])


def store_base(
    raw: DataFrame,
    communities: DataFrame | None = None,
    calendar: DataFrame | None = None,
    force_active: Sequence[str] | DataFrame = (),
) -> DataFrame:
    """Stores with a key, filled in, normalised and flagged, online ones included.

    Stores listed in ``force_active`` are active and open whatever their class;
    without classes there are no flags.
    """
    df = require_keys(check_columns(raw, REQUIRED, "store"), ["store_code"])
    df = with_columns_or_null(df, ["country", "segment", "building_type"])
    if communities is not None:
        df = lookup_fill(df, communities, "store_code", "community_id", "int")
    if calendar is not None:
        # as text, like the store's own dates: an unreadable own date is not replaced
        dates = newest_calendar(calendar).select(
            "store_code", *[F.col(c).cast("string").alias(c) for c in ("opening_date", "closing_date")]
        )
        df = fill_from(df, dates, "store_code", ["opening_date", "closing_date"])
    df = df.withColumn("country", normalise_country("country"))
    zone = strip_last("first_price") if find_column(df, "first_price") else F.col("country")
    flags = {"market_zone": zone}
    if find_column(df, "class"):
        # a store without a class is neither active nor closed
        flags["is_active"] = flag_differs("class", CLOSED)
        flags["is_closed"] = flag_equals("class", CLOSED)
    df = df.withColumns(flags)
    if "is_active" not in flags:
        return df
    return override(df, "store_code", force_active, {"is_active": 1, "is_closed": 0})


def store_feed(
    raw: DataFrame,
    communities: DataFrame | None = None,
    calendar: DataFrame | None = None,
    force_active: Sequence[str] | DataFrame = (),
    null_token: str | None = None,
) -> DataFrame:
    """The store feed: physical stores with flags, market zone and a four-level hierarchy.

    ``null_token`` stands for missing levels in the codes and so keeps paths apart.
    """
    df = exclude_value(store_base(raw, communities, calendar, force_active), "country", ONLINE)
    levels = [
        map_value("country", COUNTRY_NAMES),
        blank_to_null("segment"),
        blank_to_null("building_type"),
        F.trim("store_code"),
    ]
    return conform(hierarchy(df, levels, null_token=null_token), STORE)


def store_report(raw: DataFrame) -> DataFrame:
    """Quality report on raw stores: blank keys and stores without a country."""
    df = with_columns_or_null(check_columns(raw, REQUIRED, "store"), ["country"])
    no_country = Check("no_country", "country", "WARN", normalise_country("country") == ONLINE)
    return quality_report(df, [blank_check("store_code"), no_country])


def store_totals(raw: DataFrame, force_active: Sequence[str] | DataFrame = ()) -> DataFrame:
    """Total, active, closed and online stores; active and closed are NULL without classes."""
    stores = store_base(raw, force_active=force_active)
    stores = with_columns_or_null(stores, ["is_active", "is_closed"], "int")
    return store_stats(stores, "country", "is_active", "is_closed", ONLINE)
