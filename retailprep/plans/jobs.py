"""Jobs: read the delivered files, check them, build a feed and publish it.

Each job returns its reports as DataFrames.  Those that count the rows of a feed
are taken while the feed is written (a handful of numbers reaches the driver);
the others are computed when the caller looks at them.  Paths are Spark paths;
credentials belong to the session.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.enrich import active_keys
from ..operators.quality import check_not_empty, duplicate_keys
from ..operators.schema import check_columns
from ..session import settle
from ..sources.read import find_column, optional, read_dictionary, read_feed, read_latest
from ..sources.write import check_outputs, publish
from . import price, product, sales, stock, store

Reports = dict[str, DataFrame]


def import_stores(
    spark: SparkSession,
    stores: str,
    full: str | None = None,
    sample: str | None = None,
    communities: str | None = None,
    calendar: str | None = None,
    force_active: Sequence[str] = (),
    mode: str = "FULL",
    null_token: str | None = None,
) -> Reports:
    raw = check_not_empty(check_columns(read_feed(spark, stores), store.REQUIRED, "store"), "store")
    community_rows = calendar_rows = None
    if communities:
        ddl = "store_code string, community_id string"
        community_rows = optional(lambda: read_feed(spark, communities), ddl, spark)
    if calendar:
        ddl = "store_code string, opening_date date, closing_date date"
        calendar_rows = optional(lambda: read_feed(spark, calendar, schema=ddl), ddl, spark)
    feed = store.store_feed(raw, community_rows, calendar_rows, force_active, null_token=null_token)
    publish(feed, full, sample, mode, sample_order=["external_id"], order_by=["external_id"])
    return {"quality": store.store_report(raw), "totals": store.store_totals(raw, force_active)}


def known_products(spark: SparkSession, dictionary: str) -> DataFrame:
    """Distinct codes of the product dictionary, each snapshot under its own names; empty before the first delivery."""
    return optional(lambda: read_dictionary(spark, dictionary, product.DICTIONARY).distinct(), "product_code string", spark)


def import_products(
    spark: SparkSession,
    products: str,
    attributes: str,
    definitions: str,
    warehouse: str,
    store_stock_folder: str | None,
    dictionary: str,
    year: int,
    full: str | None = None,
    sample: str | None = None,
    kind: str = "FULL",
    mode: str = "FULL",
    as_tuple: bool = False,
) -> Reports:
    """``kind`` DELTA publishes only products the dictionary does not have; ``year`` dates the season report."""
    if kind not in ("FULL", "DELTA"):
        raise ValueError(f"unknown kind {kind!r}, expected FULL or DELTA")
    raw = check_not_empty(check_columns(read_feed(spark, products), product.REQUIRED, "product"), "product")
    # the catalogue is read once: what follows reads it from the shared folder, and its blanks are counted on the way there
    raw, quality = product.product_counts().observed(raw)
    raw = settle(raw)
    code = "product_code string"
    sources = [read_feed(spark, warehouse, sep="|").select("product_code")]
    if store_stock_folder:
        latest = optional(lambda: read_latest(spark, store_stock_folder, "inventory_"), code, spark)
        sources.append(latest.select("product_code"))
    known = known_products(spark, dictionary)
    active = settle(active_keys("product_code", *sources, known))
    enriched, names = product.enriched_products(
        raw, read_feed(spark, attributes), read_feed(spark, definitions), active, settled=True, as_tuple=as_tuple
    )
    feed = product.product_output(enriched, names, known if kind == "DELTA" else None)
    order = ["parent_product_code", "external_id"]
    publish(feed, full, sample, mode, sample_order=order, order_by=order)
    reports = {
        "quality": quality(),
        "stats": product.catalogue_stats(raw, active, known),
        "duplicates": duplicate_keys(raw, ["product_code", "size_code"]),
    }
    if find_column(enriched, "season"):
        reports["seasons"] = product.season_stats(enriched, known, year)
    if find_column(enriched, "storedepartment"):
        reports["departments"] = product.department_report(enriched)
    return reports


def import_prices(
    spark: SparkSession,
    base: str,
    retail: str,
    stores: str,
    product_dictionary: str,
    full: str | None = None,
    sample: str | None = None,
    price_dictionary: str | None = None,
    zones: Sequence[str] | None = None,
    min_date: str | None = None,
    currency: str | None = None,
    mode: str = "FULL",
    compare: Sequence[str] = ("end_date",),
    replace: str = "ALL",
    expected_products: int | None = None,
) -> Reports:
    """One folder per price list; with ``price_dictionary`` only new and changed prices (DELTA).

    ``replace="LISTS"`` leaves the folders of lists that have no rows now.
    ``expected_products`` is for feeds of mostly unknown products (see ``price.current_prices``).
    """
    check_outputs(full, sample, mode)
    known = None
    if price_dictionary:
        ddl = "name string, product_code string, start_date date, end_date date, value decimal(15,2)"
        known = optional(lambda: price.known_prices(read_dictionary(spark, price_dictionary, price.DICTIONARY)), ddl, spark)
    feed = settle(
        price.price_feed(
            read_feed(spark, base, sep="|"),
            read_feed(spark, retail, sep="|"),
            read_feed(spark, stores),
            read_dictionary(spark, product_dictionary, price.PRODUCTS),
            zones,
            min_date,
            currency,
            known,
            compare,
            expected_products,
        )
    )
    keys = ["product_code", "start_date"]
    publish(
        price.price_output(feed),
        full,
        sample,
        mode,
        sample_order=keys,
        sample_by="name",
        partition_by="name",
        settled=True,
        replace=replace,
    )
    return {"lists": price.price_totals(feed), "totals": price.export_totals(feed)}


def import_store_stock(
    spark: SparkSession,
    folder: str,
    full: str | None = None,
    sample: str | None = None,
    file_mode: str = "LATEST",
    name: str | None = None,
    drop_zero: bool = False,
    mode: str = "FULL",
    strict: bool = True,
) -> Reports:
    raw = read_latest(spark, folder, "inventory_", file_mode, name, trim=True)
    feed = stock.store_stock_feed(raw, drop_zero, strict)
    publish(feed, full, sample, mode, sample_order=["point_of_sale_code", "product_code"])
    return {}


def import_warehouse_stock(
    spark: SparkSession, path: str, full: str | None = None, sample: str | None = None, mode: str = "FULL"
) -> Reports:
    raw = check_columns(read_feed(spark, path, sep="|"), stock.WAREHOUSE_REQUIRED, "warehouse stock")
    feed, blanks = stock.warehouse_feed_profiled(check_not_empty(raw, "warehouse stock"))
    publish(feed, full, sample, mode, sample_order=["warehouse_code", "product_code"])
    return {"blanks": blanks()}


def import_inbound(
    spark: SparkSession,
    orders: str,
    transit: str,
    full: str | None = None,
    sample: str | None = None,
    mode: str = "FULL",
) -> Reports:
    open_orders = check_not_empty(read_feed(spark, orders, sep="|"), "open orders")
    in_transit = check_not_empty(read_feed(spark, transit, sep="|"), "goods in transit")
    feed, volume = stock.inbound_feed_audited(open_orders, in_transit)
    publish(feed, full, sample, mode, sample_order=["point_of_sale_code", "product_code", "delivery_date"])
    return {"volume": volume()}


def import_sales(
    spark: SparkSession,
    transactions: str | list[str] | None,
    stores: str,
    base: str,
    retail: str,
    is_return: Column,
    full: str | None = None,
    sample: str | None = None,
    online: Sequence[str] = (),
    keys: Sequence[str] = (),
    sep: str = ";",
    mode: str = "FULL",
    folder: str | None = None,
    file_mode: str = "LATEST",
    name: str | None = None,
) -> Reports:
    """``is_return`` marks returned rows of the transaction files; ``keys`` identify a sale.

    Without ``transactions`` the newest ``transactional_sales_`` delivery of
    ``folder`` is read (LATEST), or the one called ``name`` (MANUAL).
    """
    check_outputs(full, sample, mode)
    if transactions:
        read = read_feed(spark, transactions, sep=sep)
    elif folder:
        read = read_latest(spark, folder, "transactional_sales_", file_mode, name, sep=sep)
    else:
        raise ValueError("sales need transactions or a folder")
    raw = check_columns(read, sales.REQUIRED, "sales")
    store_rows = read_feed(spark, stores)
    base_prices, retail_prices = (price.price_clean(read_feed(spark, p, sep="|")) for p in (base, retail))
    audited = sales.sales_feed(raw, store_rows, base_prices, retail_prices, is_return, online, keys, audit=True)
    feed, unmatched = sales.observed_sales(audited)
    publish(feed, full, sample, mode, sample_order=[*keys, "store_code", "product_code", "sale_date"])
    found = unmatched()
    return {"rows": found.select(F.col("sales").alias("rows")), "unmatched": found}
