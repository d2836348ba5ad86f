"""Unit conversions, error trends and product status."""

from retailprep.operators import diagnostics, units

from .fixtures import with_clause
from .registry import query

TABLE = """directions AS (
    SELECT "group", from_unit, to_unit, 1.0 AS multiply, CAST(factor AS DECIMAL(18,6)) AS divide FROM unit_conversion
    UNION ALL SELECT "group", to_unit, from_unit, CAST(factor AS DECIMAL(18,6)), 1.0 FROM unit_conversion),
rules AS (
    SELECT "group", from_unit AS unit, to_unit AS sales_unit, min(multiply) AS multiply, min(divide) AS divide,
           count(DISTINCT (multiply, divide)) AS versions
    FROM directions GROUP BY "group", from_unit, to_unit)"""
KEYS = "s.context, s.l_orderkey, s.l_partkey, s.l_suppkey, s.l_linenumber, s.l_shipdate"


@query(
    "unit_convert",
    with_clause("unit_stock", "unit_product", "unit_conversion", more=TABLE)
    + f"""SELECT {KEYS}, s.product_code, s.unit, s.amount, p.sales_unit,
            CASE WHEN s.unit = p.sales_unit THEN CAST(s.amount AS DECIMAL(18,6))
                 WHEN r.versions = 1 THEN CAST(s.amount * r.multiply / r.divide AS DECIMAL(18,6)) END AS converted,
            CASE WHEN p.sales_unit IS NULL THEN 'unknown_product' WHEN s.unit = p.sales_unit THEN 'same'
                 WHEN r.versions IS NULL THEN 'missing' WHEN r.versions > 1 THEN 'ambiguous' ELSE 'converted' END AS status
        FROM unit_stock s LEFT JOIN (SELECT DISTINCT ON (product_code) * FROM unit_product ORDER BY product_code, sales_unit, "group") p ON p.product_code = s.product_code
        LEFT JOIN rules r ON r."group" = p."group" AND r.unit = s.unit AND r.sales_unit = p.sales_unit""",
)
def unit_convert(t):
    return units.convert_units(t.unit_stock, t.unit_product, t.unit_conversion)


@query(
    "unit_missing",
    with_clause("unit_stock", "unit_product", "unit_conversion", more=TABLE)
    + """SELECT s.context, s.unit, p.sales_unit, count(*) AS rows, count(DISTINCT s.product_code) AS products
        FROM unit_stock s JOIN (SELECT DISTINCT ON (product_code) * FROM unit_product ORDER BY product_code, sales_unit, "group") p ON p.product_code = s.product_code
        LEFT JOIN rules r ON r."group" = p."group" AND r.unit = s.unit AND r.sales_unit = p.sales_unit
        WHERE s.unit <> p.sales_unit AND r.versions IS NULL GROUP BY ALL""",
)
def _(t):
    return units.missing_conversions(t.unit_stock, t.unit_product, t.unit_conversion, ["context"])


@query(
    "unit_ambiguous",
    with_clause("unit_conversion")
    + """SELECT "group", from_unit, count(DISTINCT to_unit) AS targets FROM unit_conversion
        GROUP BY "group", from_unit HAVING count(DISTINCT to_unit) > 1""",
)
def _(t):
    return units.ambiguous_conversions(t.unit_conversion)


@query(
    "error_trend",
    with_clause("errors_raw")
    + """, spans AS (SELECT code, error_key, min(error_day) AS first_day, max(error_day) AS last_day FROM errors_raw GROUP BY ALL),
        per_day AS (SELECT code, error_day, count(*) AS errors, count(DISTINCT error_key) AS keys FROM errors_raw GROUP BY ALL),
        counted AS (SELECT d.*,
            (SELECT count(*) FROM spans s WHERE s.code = d.code AND s.first_day = d.error_day) AS new_keys,
            (SELECT count(*) FROM spans s WHERE s.code = d.code AND s.last_day = d.error_day) AS last_seen_keys
            FROM per_day d)
        SELECT *, CAST(sum(new_keys) OVER (PARTITION BY code ORDER BY error_day) AS BIGINT) AS keys_so_far FROM counted""",
)
def _(t):
    return diagnostics.error_trend(t.errors_raw, "code", "error_key", "error_day")


@query(
    "error_unresolved",
    with_clause("errors_raw")
    + """SELECT code, error_key, min(error_day) AS first_day, max(error_day) AS last_day FROM errors_raw e
        GROUP BY code, error_key
        HAVING max(error_day) = (SELECT max(error_day) FROM errors_raw x WHERE x.code = e.code)""",
)
def _(t):
    return diagnostics.unresolved_keys(t.errors_raw, "code", "error_key", "error_day")


@query(
    "inactive_parents",
    with_clause("variants")
    + """SELECT parent, count(*) AS variants FROM variants GROUP BY parent
        HAVING max(COALESCE(is_active, 0)) = 0""",
)
def _(t):
    return diagnostics.inactive_parents(t.variants, "parent", "is_active")


@query(
    "inactive_variants",
    with_clause("variants", "inventory_recent")
    + """SELECT product_code, variant, parent, is_active, unit FROM variants v
        WHERE COALESCE(is_active, 0) <> 1
            AND parent IN (SELECT parent FROM variants WHERE is_active = 1)
            AND product_code IN (SELECT product_code FROM inventory_recent)""",
)
def _(t):
    return diagnostics.inactive_variants(
        t.variants, t.variants, "parent", "product_code", "is_active", moving=t.inventory_recent
    )


@query(
    "product_profile",
    with_clause("variants") + "SELECT is_active, unit, count(*) AS rows FROM variants GROUP BY ALL",
)
def _(t):
    return diagnostics.profile_counts(t.variants, ["is_active", "unit"])
