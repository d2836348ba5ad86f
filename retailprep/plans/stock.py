"""Stock in stores and warehouses, and inbound goods."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import is_blank, parse_date, parse_decimal
from ..operators.enrich import stack
from ..operators.quality import audited, null_counts, null_profile, volume_audit
from ..operators.schema import Spec, check_columns, conform

UNIT = "ST"

# Fixed values of the contract.
STOCK_REQUIRED = ("store_code", "product_code", "inventory", "inventory_date", "stock_cost", "currency")
WAREHOUSE_REQUIRED = ("inventory_warehouse_date", "warehouse_code", "product_code", "inventory")
ORDERS_REQUIRED = ("destination_code", "product_code", "quantity_ordered", "estimated_arrival_date")
TRANSIT_REQUIRED = ("destination_code", "product_code", "quantity", "estimated_arrival_date")

# Target columns of the stock feeds.
STORE_STOCK = Spec(
    columns={
        "date_point_of_sale_level": "date",
        "point_of_sale_code": "string",
        "product_code": "string",
        "amount": "decimal(15,3)",
        "unit_of_measure_code": "string",
        "point_of_sale_section_code": "string",
        "point_of_sale_shelf_code": "string",
        "stock_cost": "decimal(15,2)",
        "currency": "string",
    },
    mapping={
        "date_point_of_sale_level": "inventory_date",
        "point_of_sale_code": "store_code",
        "amount": "inventory",
    },
    constants={"unit_of_measure_code": UNIT},
    exclude=frozenset({"point_of_sale_section_code", "point_of_sale_shelf_code"}),
)
WAREHOUSE_STOCK = Spec(
    columns={
        "date_stock_level": "date",
        "warehouse_code": "string",
        "product_code": "string",
        "amount": "decimal(15,3)",
        "warehouse_unit_of_measure_code": "string",
    },
    mapping={"date_stock_level": "inventory_warehouse_date", "amount": "inventory"},
    constants={"warehouse_unit_of_measure_code": UNIT},
)
INBOUND = Spec(
    columns={
        "point_of_sale_code": "string",
        "product_code": "string",
        "amount": "decimal(15,3)",
        "unit_of_measure_code": "string",
        "delivery_date": "date",
    },
    constants={"unit_of_measure_code": UNIT},
)


def store_stock_feed(raw: DataFrame, drop_zero: bool = False, strict: bool = True) -> DataFrame:
    """Store stock with readable numbers and dates.

    A number with blanks inside is NULL unless ``strict`` is off.  Rows of zero
    stock pass unless ``drop_zero`` is set; the receiving side takes an absent
    row as zero.
    """
    df = check_columns(raw, STOCK_REQUIRED, "store stock").withColumns(
        {
            "inventory": parse_decimal("inventory", 15, 3, strict),
            "stock_cost": parse_decimal("stock_cost", 15, 2, strict),
            "inventory_date": parse_date("inventory_date"),
        }
    )
    out = conform(df, STORE_STOCK)
    return out.filter(F.col("amount") != 0) if drop_zero else out


def _warehouse_clean(raw: DataFrame) -> DataFrame:
    return check_columns(raw, WAREHOUSE_REQUIRED, "warehouse stock").withColumns(
        {
            "inventory": parse_decimal("inventory", 15, 3, strict=True),
            "inventory_warehouse_date": parse_date("inventory_warehouse_date"),
        }
    )


def warehouse_stock_feed(raw: DataFrame) -> DataFrame:
    return conform(_warehouse_clean(raw), WAREHOUSE_STOCK)


def warehouse_feed_profiled(raw: DataFrame) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``warehouse_stock_feed`` and its ``warehouse_profile``, which is counted while the feed is written."""
    clean, report = null_counts(WAREHOUSE_REQUIRED).observed(_warehouse_clean(raw))
    return conform(clean, WAREHOUSE_STOCK), report


def warehouse_profile(raw: DataFrame) -> DataFrame:
    """Blanks per required column after cleaning; rows with blanks stay in the feed."""
    return null_profile(_warehouse_clean(raw), WAREHOUSE_REQUIRED)


def inbound_rows(orders: DataFrame, transit: DataFrame) -> DataFrame:
    """Open orders and goods in transit in one schema, before any filter."""

    def mapped(df: DataFrame, quantity: str) -> DataFrame:
        return df.select(
            F.trim("destination_code").alias("point_of_sale_code"),
            F.trim("product_code").alias("product_code"),
            parse_decimal(quantity, 15, 3, strict=True).alias("amount"),
            parse_date("estimated_arrival_date").alias("delivery_date"),
        )

    return stack(
        {
            "open_orders": mapped(check_columns(orders, ORDERS_REQUIRED, "open orders"), "quantity_ordered"),
            "in_transit": mapped(check_columns(transit, TRANSIT_REQUIRED, "goods in transit"), "quantity"),
        }
    )


def inbound_reasons() -> dict[str, Column]:
    """Why an inbound row is dropped, in order."""
    return {
        "blank_key": is_blank("point_of_sale_code") | is_blank("product_code"),
        "no_date": F.col("delivery_date").isNull(),
    }


def inbound_feed(orders: DataFrame, transit: DataFrame) -> DataFrame:
    """Expected deliveries with a key and a date."""
    rows = inbound_rows(orders, transit)
    for reason in inbound_reasons().values():
        rows = rows.filter(~reason)
    return conform(rows, INBOUND)


def inbound_feed_audited(orders: DataFrame, transit: DataFrame) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``inbound_feed`` and its ``inbound_audit``, which is counted while the feed is written."""
    kept, report = audited(inbound_rows(orders, transit), inbound_reasons())
    return conform(kept, INBOUND), report


def inbound_audit(orders: DataFrame, transit: DataFrame) -> DataFrame:
    return volume_audit(inbound_rows(orders, transit), inbound_reasons())
