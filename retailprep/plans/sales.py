"""Sales with the price valid on the day.

Returns change sign, each sale gets the newest base and promotional price on or
before its day, a fallback fills gaps, and values come out as DECIMAL(13,2).
The order of the fallback (promotional, base, the sale's own unit price) is
this package's choice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.retail import market_code, normalise_country, signed
from ..functions.text import DATE_FORMATS, parse_date, parse_decimal
from ..operators.enrich import lookup_join
from ..operators.keys import first_rows
from ..operators.quality import Report
from ..operators.schema import check_columns
from ..operators.temporal import asof_windows, price_fallback
from ..session import settle

REQUIRED = ("store_code", "product_code", "sale_date", "quantity", "value")
MONEY = "decimal(13,2)"
PRICED_BY = ("product_code", "first_price", "actual_price", "sale_date")


def sign_returns(df: DataFrame, is_return: Column, columns: Sequence[str]) -> DataFrame:
    """Flip the sign of the columns on returned rows."""
    return df.withColumns({c: signed(c, is_return) for c in columns})


def _zone_prices(sold: DataFrame, base: DataFrame, retail: DataFrame, audit: bool) -> DataFrame:
    """Both prices per distinct product, pair of zones and day; with ``audit`` also whether the product has any price.

    Looking prices up here, not per sale, shuffles the sales once instead of
    once per list.  What is distinct is written once, not computed with the sales,
    and windowed as it is, for both prices in one shuffle by the product: a pair of
    zones is a store's, so that a product, zone and day have few rows.
    """
    lists = {}
    for zone, quotes, price in (("first_price", base, "price_base"), ("actual_price", retail, "price_promo")):
        columns = ["product_code", F.col("zone").alias(zone), "start_date", F.col("value").alias(price)]
        lists[price] = (quotes.select(*columns), zone, "start_date")
    out = asof_windows(settle(sold.select(*PRICED_BY).distinct()), "sale_date", "product_code", lists)
    extra = []
    if audit:
        listed = base.select("product_code").unionByName(retail.select("product_code"))
        listed = listed.select(F.trim("product_code").alias("product_code")).distinct().withColumn("__priced", F.lit(True))
        out, extra = lookup_join(out, listed, ["product_code"]), ["__priced"]
    return out.select(*[F.col(c).alias(f"__{c}") for c in PRICED_BY], "price_base", "price_promo", *extra)


def sales_feed(
    sales: DataFrame,
    stores: DataFrame,
    base: DataFrame,
    retail: DataFrame,
    is_return: Column,
    online: Sequence[str] = (),
    keys: Sequence[str] = (),
    audit: bool = False,
) -> DataFrame:
    """The sales feed, one row per sale.

    ``stores`` gives country and price zones, ``base`` and ``retail`` are clean
    prices (product_code, zone, start_date, value).  ``keys`` pass through.
    Codes are trimmed.  ``audit`` adds the flags ``unknown_store`` (not listed)
    and ``without_price`` (no price of the product at all); see ``observed_sales``.
    """
    check_columns(sales, REQUIRED, "sales")
    order = [F.col(c).asc_nulls_last() for c in ("country", "first_price", "actual_price")]
    zones = first_rows(
        stores.select(
            F.trim("store_code").alias("store_code"),
            "country",
            F.trim("first_price").alias("first_price"),
            F.trim("actual_price").alias("actual_price"),
        ),
        ["store_code"],
        order,
    )
    # Of a known size once it is written: stores are broadcast as long as Spark holds them for small enough.
    zones = settle(zones.withColumnRenamed("store_code", "__store")).withColumnRenamed("__store", "store_code")
    text = {c for c, t in sales.dtypes if t == "string"}
    typed = {c: parse_decimal(c, 13, 2) if c in text else F.col(c).try_cast(MONEY) for c in ("quantity", "value")}
    if "sale_date" in text:
        typed["sale_date"] = parse_date("sale_date", DATE_FORMATS)
    sold = sign_returns(sales.withColumns(typed), is_return, ["quantity", "value"])
    sold = sold.select(*keys, *REQUIRED).withColumns({c: F.trim(c) for c in ("store_code", "product_code")})
    sold = lookup_join(sold, zones.withColumn("__listed", F.lit(True)) if audit else zones, ["store_code"])
    flags = {"unknown_store": "__listed", "without_price": "__priced"} if audit else {}
    priced = sold.join(
        _zone_prices(sold, base, retail, audit),
        reduce(lambda x, y: x & y, [sold[c].eqNullSafe(F.col(f"__{c}")) for c in PRICED_BY]),
        "left",
    )
    unit_price = F.try_divide(F.abs("value"), F.abs("quantity"))
    return priced.select(
        *keys,
        "sale_date",
        "store_code",
        market_code("store_code", normalise_country("country"), online).alias("market_code"),
        "product_code",
        F.col("quantity").cast(MONEY).alias("quantity"),
        F.col("value").cast(MONEY).alias("value"),
        F.col("price_base").try_cast(MONEY).alias("price_base"),
        F.col("price_promo").try_cast(MONEY).alias("price_promo"),
        price_fallback("price_promo", "price_base", unit_price).try_cast(MONEY).alias("price"),
        *[F.col(found).isNull().alias(flag) for flag, found in flags.items()],
    )


def observed_sales(audited: DataFrame) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """The feed without its flags, and its ``unmatched_codes``, counted while the feed is written."""
    flags = ("unknown_store", "without_price")
    counts = Report({"sales": F.count(F.lit(1))} | {flag: F.count_if(flag) for flag in flags}, lambda line: line)
    feed, report = counts.observed(audited)
    return feed.drop(*flags), report


def unmatched_codes(sales: DataFrame, stores: DataFrame, base: DataFrame, retail: DataFrame) -> DataFrame:
    """One row: sales, those of a store that is not listed, and those of a product without any price."""
    trimmed = {c: F.trim(c) for c in ("store_code", "product_code")}
    sold = sales.select(*trimmed).withColumns(trimmed).groupBy(*trimmed).agg(F.count(F.lit(1)).alias("n"))
    listed = stores.select(F.trim("store_code").alias("store_code")).distinct().withColumn("listed", F.lit(1))
    priced = base.select("product_code").unionByName(retail.select("product_code"))
    priced = priced.select(F.trim("product_code").alias("product_code")).distinct().withColumn("priced", F.lit(1))
    joined = lookup_join(lookup_join(sold, listed, ["store_code"]), priced, ["product_code"])
    return joined.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("sales"),
        F.coalesce(F.sum(F.when(F.col("listed").isNull(), F.col("n"))), F.lit(0)).alias("unknown_store"),
        F.coalesce(F.sum(F.when(F.col("priced").isNull(), F.col("n"))), F.lit(0)).alias("without_price"),
    )
