"""Stores: lookups, calendar, flags, hierarchy and the whole feed."""

from pyspark.sql import functions as F

from retailprep.functions import COUNTRY_NAMES, blank_to_null, map_value
from retailprep.operators.attributes import hierarchy
from retailprep.operators.enrich import fill_from, lookup_fill, override
from retailprep.operators.quality import match_rate
from retailprep.operators.schema import conform
from retailprep.plans import store
from retailprep.session import scratch_path
from retailprep.sources import read_feed, write_feed

from .fixtures import with_clause
from .registry import query
from .text_queries import code10, country

CALENDAR = """newest AS (
    SELECT store_code, opening_date, closing_date FROM (
        SELECT *, row_number() OVER (PARTITION BY store_code
                                     ORDER BY opening_date DESC NULLS LAST, closing_date NULLS LAST) AS rn
        FROM calendar_raw) WHERE rn = 1)"""
COMMUNITY = """community AS (
    SELECT trim(store_code) AS store_code, min(TRY_CAST(community_id AS INTEGER)) AS community_id
    FROM community_raw WHERE TRY_CAST(community_id AS INTEGER) IS NOT NULL GROUP BY 1)"""
NAMES = ", ".join(f"('{k}', '{v}')" for k, v in COUNTRY_NAMES.items())
LEVELS = f"""named AS (
    SELECT s.*, COALESCE(n.name, s.country_code) AS l1, nullif(trim(segment), '') AS l2,
           nullif(trim(building_type), '') AS l3, trim(store_code) AS l4
    FROM (SELECT *, {country('country')} AS country_code FROM store_raw WHERE trim(store_code) <> '') s
    LEFT JOIN (VALUES {NAMES}) n(code, name) ON n.code = s.country_code),
levels AS (
    SELECT *, {code10('l1')} AS c1, {code10("concat_ws('|', l1, l2)")} AS c2,
           {code10("concat_ws('|', l1, l2, l3)")} AS c3, {code10("concat_ws('|', l1, l2, l3, l4)")} AS c4
    FROM named)"""
LEVEL_COLUMNS = ", ".join(
    f"l{i} AS category_level{i}_name, c{i} AS category_level{i}_code" for i in range(1, 5)
)
FORCED = "SELECT s_name FROM supplier WHERE s_acctbal < -300"


def forced(t):
    return t.supplier.filter("s_acctbal < -300").select("s_name")


def calendar_file(t):
    """The calendar written as a file and read back with declared types."""
    path = scratch_path(t.spark, "store_activity_calendar.csv")
    write_feed(t.calendar_raw, path)
    return read_feed(t.spark, path, schema="store_code string, opening_date date, closing_date date")


@query("calendar_latest", with_clause("calendar_raw", more=CALENDAR) + "SELECT * FROM newest")
def _(t):
    return store.newest_calendar(t.calendar_raw)


@query(
    "calendar_fill",
    with_clause("store_raw", "calendar_raw", more=CALENDAR)
    + """SELECT s.store_description, COALESCE(CAST(s.opening_date AS DATE), n.opening_date) AS opening_date,
            n.closing_date FROM store_raw s LEFT JOIN newest n ON s.store_code = n.store_code""",
)
def _(t):
    stores = t.store_raw.select(
        "store_code", "store_description", F.col("opening_date").try_cast("date").alias("opening_date")
    )
    dates = store.newest_calendar(calendar_file(t))
    filled = fill_from(stores, dates, "store_code", ["opening_date", "closing_date"])
    return filled.drop("store_code")


@query(
    "lookup_fill",
    with_clause("store_raw", "community_raw", more=COMMUNITY)
    + """SELECT s.store_description, c.community_id
        FROM store_raw s LEFT JOIN community c ON trim(s.store_code) = c.store_code""",
)
def _(t):
    stores = t.store_raw.select("store_code", "store_description")
    return lookup_fill(stores, t.community_raw, "store_code", "community_id", "int").drop("store_code")


@query(
    "lookup_match_rate",
    with_clause("store_raw", "community_raw", more=COMMUNITY)
    + """SELECT rows, matched,
            CAST(CAST((matched * 200000 + rows) // (2 * rows) AS DECIMAL(18,0)) / 1000 AS DECIMAL(7,3)) AS share
        FROM (SELECT count(*) AS rows, count(c.community_id) AS matched
              FROM store_raw s LEFT JOIN community c ON trim(s.store_code) = c.store_code)""",
)
def _(t):
    filled = lookup_fill(t.store_raw.select("store_code"), t.community_raw, "store_code", "community_id", "int")
    return match_rate(filled, "community_id")


@query(
    "override_flags",
    with_clause("store_raw")
    + f"""SELECT store_description, CASE WHEN store_code IN ({FORCED}) THEN 1 WHEN class <> 'ZAMKNIETE' THEN 1 ELSE 0 END
            AS is_active,
            CASE WHEN store_code IN ({FORCED}) THEN 0 WHEN class = 'ZAMKNIETE' THEN 1 ELSE 0 END AS is_closed
        FROM store_raw WHERE trim(store_code) <> ''""",
)
def _(t):
    stores = store.store_base(t.store_raw)
    out = override(stores, "store_code", forced(t), {"is_active": 1, "is_closed": 0})
    return out.select("store_description", "is_active", "is_closed")


@query(
    "store_hierarchy",
    with_clause("store_raw", more=LEVELS) + f"SELECT store_description, {LEVEL_COLUMNS} FROM levels",
)
def _(t):
    stores = store.store_base(t.store_raw)
    levels = [
        map_value("country", COUNTRY_NAMES),
        blank_to_null("segment"),
        blank_to_null("building_type"),
        F.trim("store_code"),
    ]
    names = [f"category_level{i}_{part}" for i in range(1, 5) for part in ("name", "code")]
    return hierarchy(stores, levels).select("store_description", *names)


@query(
    "conform_store",
    with_clause("store_raw")
    + """SELECT store_code AS external_id, store_code AS code, store_description AS name, country AS country_symbol,
            CAST(NULL AS VARCHAR) AS market_code, building_type AS sales_channel_code,
            CAST(opening_date AS DATE) AS opening_date, CAST(NULL AS DATE) AS closing_date,
            CAST(NULL AS INTEGER) AS is_active, CAST(NULL AS INTEGER) AS is_closed,
            TRY_CAST(gross_area AS DECIMAL(15,2)) AS surface_area, city AS city_name, zip AS zip_code,
            TRY_CAST(longitude AS DECIMAL(13,6)) AS longitude, TRY_CAST(latitude AS DECIMAL(13,6)) AS latitude,
            CAST(NULL AS VARCHAR) AS channel_type, CAST(NULL AS VARCHAR) AS local_currency, first_price, actual_price,
            segment, CAST(NULL AS INTEGER) AS community_id, """
    + ", ".join(f"CAST(NULL AS VARCHAR) AS category_level{i}_{p}" for i in range(1, 5) for p in ("name", "code"))
    + ", mos_attribute_1, mos_attribute_2 FROM store_raw",
)
def _(t):
    return conform(t.store_raw, store.STORE)


@query(
    "store_feed",
    with_clause("store_raw", "community_raw", "calendar_raw", more=f"{CALENDAR}, {COMMUNITY}, {LEVELS}")
    + f"""SELECT l.store_code AS external_id, l.store_code AS code, store_description AS name,
            country_code AS country_symbol,
            substr(trim(first_price), 1, length(trim(first_price)) - 1) AS market_code,
            building_type AS sales_channel_code,
            COALESCE(CAST(l.opening_date AS DATE), n.opening_date) AS opening_date, n.closing_date,
            CASE WHEN l.store_code IN ({FORCED}) THEN 1 WHEN class <> 'ZAMKNIETE' THEN 1 ELSE 0 END AS is_active,
            CASE WHEN l.store_code IN ({FORCED}) THEN 0 WHEN class = 'ZAMKNIETE' THEN 1 ELSE 0 END AS is_closed,
            TRY_CAST(gross_area AS DECIMAL(15,2)) AS surface_area, city AS city_name, zip AS zip_code,
            TRY_CAST(longitude AS DECIMAL(13,6)) AS longitude, TRY_CAST(latitude AS DECIMAL(13,6)) AS latitude,
            CAST(NULL AS VARCHAR) AS channel_type, CAST(NULL AS VARCHAR) AS local_currency, first_price, actual_price,
            segment, c.community_id, {LEVEL_COLUMNS}, mos_attribute_1, mos_attribute_2
        FROM levels l LEFT JOIN newest n ON n.store_code = l.store_code
        LEFT JOIN community c ON c.store_code = trim(l.store_code)
        WHERE country_code <> 'Eshop'""",
)
def store_feed(t):
    return store.store_feed(t.store_raw, t.community_raw, t.calendar_raw, forced(t))


@query(
    "store_stats",
    with_clause("store_raw")
    + f"""SELECT count(*) AS total,
            count(*) FILTER (WHERE code <> 'Eshop' AND class <> 'ZAMKNIETE') AS active,
            count(*) FILTER (WHERE code <> 'Eshop' AND class = 'ZAMKNIETE') AS closed,
            count(*) FILTER (WHERE code = 'Eshop') AS online
        FROM (SELECT *, {country('country')} AS code FROM store_raw WHERE trim(store_code) <> '')""",
)
def _(t):
    return store.store_totals(t.store_raw)


@query(
    "store_quality",
    with_clause("store_raw")
    + """, counts AS (SELECT count(*) AS total, count(*) FILTER (WHERE COALESCE(trim(store_code), '') = '') AS blank,
            count(*) FILTER (WHERE COALESCE(trim(country), '') = '') AS no_country FROM store_raw),
        lines AS (SELECT 'rows' AS "check", '*' AS "column", 'INFO' AS level, total AS rows, total FROM counts
            UNION ALL SELECT 'blank', 'store_code', CASE WHEN blank > 0 THEN 'WARN' ELSE 'INFO' END, blank, total FROM counts
            UNION ALL SELECT 'no_country', 'country', CASE WHEN no_country > 0 THEN 'WARN' ELSE 'INFO' END, no_country, total
            FROM counts)
        SELECT "check", "column", level, rows,
            CAST(CAST((rows * 200000 + total) // (2 * total) AS DECIMAL(18,0)) / 1000 AS DECIMAL(7,3)) AS share FROM lines""",
)
def _(t):
    return store.store_report(t.store_raw)
