"""Price lists per market zone."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.retail import CLOSED
from ..functions.text import DATE_FORMATS, map_value, parse_date, parse_decimal, strip_last
from ..operators.delta import delta
from ..operators.enrich import exclude_value, keep_known, maybe_known, only, since, stack
from ..operators.keys import distinct_keys, global_rank
from ..operators.schema import check_columns, select_parsed
from ..operators.temporal import lowest_value, validity
from ..sources.read import find_column, first_column

# Fixed values of the contract.
REQUIRED = ("store_agg_level_code", "product_agg_level_code", "price_date", "price_with_tax")
VALUE = (15, 2)

# List name prefix and price type per source.
LIST_PREFIX = {"base": "Cennik_bazowy_", "retail": "Cennik_promocyjny_"}
PRICE_TYPE = {"base": "100", "retail": "200"}

# Fixed values of the contract.
COLUMNS = (
    "name",
    "external_id",
    "price_type_id",
    "currency_code",
    "market_code",
    "product_code",
    "value",
    "start_date",
    "end_date",
    "priority",
)

# The names the dictionaries' columns have had.
DICTIONARY = {
    "name": (("name", "external_id"), "string"),
    "product_code": (("product_code", "code"), "string"),
    "start_date": (("start_date", "valid_from"), "date"),
    "end_date": (("end_date", "valid_to"), "date"),
    "value": (("value", "price"), "decimal(15,2)"),
}
PRODUCTS = {"product_code": (("product_code", "code"), "string")}


def open_stores(stores: DataFrame) -> DataFrame:
    """Stores that are not closed; a store without a class is open."""
    return exclude_value(stores, "class", CLOSED, null_safe=True) if find_column(stores, "class") else stores


def zone_stores(stores: DataFrame) -> DataFrame:
    """(source, zone, store) of open stores, with zones of the base and the promotional list."""
    df = check_columns(stores, ["first_price", "actual_price"], "store")
    code = F.trim(first_column(df, "store_code", "code"))
    zones = {"base": "first_price", "retail": "actual_price"}
    parts = {
        source: open_stores(df).select(F.trim(F.col(c)).alias("zone"), code.alias("store_code"))
        for source, c in zones.items()
    }
    return stack(parts).filter(F.col("zone").isNotNull())


def served_zones(stores: DataFrame, zones: Sequence[str] | None = None) -> DataFrame:
    """(source, zone) pairs with an open store, of the selected zones if given."""
    return distinct_keys(only(zone_stores(stores), "zone", zones), "source", "zone")


def price_clean(raw: DataFrame, min_date: dt.date | str | None = None) -> DataFrame:
    """Readable positive prices: product, zone, day, value, currency."""
    df = check_columns(raw, REQUIRED, "price")
    currency = F.col("currency") if find_column(df, "currency") else F.lit(None).cast("string")
    columns = [
        F.trim("product_agg_level_code").alias("product_code"),
        F.trim("store_agg_level_code").alias("zone"),
        currency.alias("currency_code"),
        *([F.col("source")] if find_column(df, "source") else []),
    ]
    parsed = {
        "start_date": parse_date("price_date", DATE_FORMATS),
        "value": parse_decimal("price_with_tax", *VALUE, strict=True),
    }
    clean = select_parsed(df, columns, parsed)
    clean = clean.filter((F.col("value") > 0) & F.col("start_date").isNotNull())
    return since(clean, "start_date", min_date)


def current_prices(
    base: DataFrame,
    retail: DataFrame,
    served: DataFrame,
    products: DataFrame,
    min_date: dt.date | str | None = None,
    currency: str | None = None,
    expected_products: int | None = None,
) -> DataFrame:
    """Lowest price per source, market zone, product and day.

    Only known products in ``served`` zones (see ``served_zones``) count.  Zones
    that differ in their last letter share a market zone, and the lowest of
    their prices wins.  ``currency`` overrides the currency of the input.

    Products are checked after the aggregation, where a product has at most one
    row per list and day; Catalyst moves the check below it if it can broadcast.
    For feeds of mostly unknown products ``expected_products``, about how many
    are known, drops nearly all others at the scan (see ``maybe_known``).
    """
    raw = stack({"base": base, "retail": retail})
    known = products.select(F.trim(first_column(products, "product_code", "code")).alias("product_code"))
    prices = keep_known(price_clean(raw, min_date), served, ["source", "zone"])
    if expected_products is not None:
        prices = maybe_known(prices, known, ["product_code"], expected_products)
    prices = prices.withColumn("market_code", strip_last("zone"))
    keys = ["source", "market_code", "product_code", "start_date"]
    if currency is None:
        lowest = lowest_value(prices, keys, "value", ["currency_code"])
    else:
        lowest = lowest_value(prices, keys, "value").withColumn("currency_code", F.lit(currency))
    # by the product alone, as a product has few rows by now: the timelines that follow need no other shuffle
    return lowest.join(distinct_keys(known, "product_code"), ["product_code"], "left_semi").select(*lowest.columns)


# Price lists a feed may have while their names are ranked in one task; there is one per source and market zone.
MOST_LISTS = 100_000


def rank_names(names: DataFrame, column: str, rank: str = "priority", few: bool = False) -> DataFrame:
    """Alphabetical rank 1..n of the distinct names; there is one name per price list.

    ``few`` ranks them in one task and raises if there are more than
    ``MOST_LISTS``; otherwise ranges of names are ranked apart (``global_rank``).
    """
    if not few:
        return global_rank(names, column, rank).withColumn(rank, F.col(rank).cast("int"))
    ranked = names.select(column).distinct().withColumn(rank, F.row_number().over(Window.orderBy(column)))
    bound = F.assert_true(F.col(rank) <= MOST_LISTS, f"more than {MOST_LISTS} price lists: rank them with many_lists")
    return ranked.filter(bound.isNull())


def with_name(prices: DataFrame) -> DataFrame:
    """Add the list name: the source's prefix and the market zone."""
    return prices.withColumn("name", F.concat(map_value("source", LIST_PREFIX), F.col("market_code")))


def with_priority(prices: DataFrame, many_lists: bool = False) -> DataFrame:
    """Add the list name and its priority among the lists that have prices."""
    named = with_name(prices)
    # prices are positive; asking for it keeps the value in this branch, so that both read one shuffle of the prices
    ranked = rank_names(named.filter(F.col("value") > 0), "name", few=not many_lists)
    # few names are bounded, and a join by the name would shuffle all prices to the tasks of their lists
    lists = ranked if many_lists else F.broadcast(ranked)
    # every name has a rank; an inner join would push a null check on the built name down to the scan
    return named.join(lists, "name", "left")


def price_feed(
    base: DataFrame,
    retail: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    zones: Sequence[str] | None = None,
    min_date: dt.date | str | None = None,
    currency: str | None = None,
    known: DataFrame | None = None,
    compare: Sequence[str] = ("end_date",),
    expected_products: int | None = None,
    many_lists: bool = False,
) -> DataFrame:
    """The price feed; with ``known`` (the price dictionary) only new and changed rows (DELTA).

    A price is valid until the day before the product's next one in the list.
    Priorities rank all lists, also for a delta.  A known row counts as changed
    if one of the columns ``compare`` (end_date, value) differs.
    """
    served = served_zones(stores, zones)
    prices = current_prices(base, retail, served, products, min_date, currency, expected_products)
    # sorted by product first, which tells most prices apart
    dated = validity(prices, ["product_code", "market_code", "source"], "start_date")
    full = with_priority(dated, many_lists).select(
        "name",
        F.col("name").alias("external_id"),
        map_value("source", PRICE_TYPE).alias("price_type_id"),
        "currency_code",
        "market_code",
        "product_code",
        "value",
        "start_date",
        "end_date",
        "priority",
    )
    if known is None:
        return full
    return delta(full, known_prices(known), ["product_code", "start_date", "name"], list(compare))


def known_prices(dictionary: DataFrame) -> DataFrame:
    """The price dictionary under the feed's own names, whichever of its schemas it has."""
    columns = {target: first_column(dictionary, *names).try_cast(dtype) for target, (names, dtype) in DICTIONARY.items()}
    columns["product_code"] = F.trim(columns["product_code"])
    return dictionary.select(*[value.alias(target) for target, value in columns.items()])


def price_output(prices: DataFrame) -> DataFrame:
    """Dates as the text the receiving side reads."""
    text = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("start_date", "end_date")}
    return prices.withColumns(text).select(*COLUMNS)


def price_totals(prices: DataFrame) -> DataFrame:
    """Rows per list and its priority."""
    return prices.groupBy("name").agg(F.count(F.lit(1)).alias("rows"), F.max("priority").alias("priority"))


def export_totals(prices: DataFrame) -> DataFrame:
    """One row: rows and lists exported."""
    return price_totals(prices).agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("lists"))
