"""Products: activity, attributes, agreement of categories and the whole feed."""

from pyspark.sql import functions as F

from retailprep.operators.attributes import (
    consensus,
    find_conflicts,
    join_attributes,
    pivot_attributes,
)
from retailprep.operators.enrich import active_keys, keep_active, new_rows
from retailprep.operators.keys import dedupe
from retailprep.operators.quality import duplicate_keys
from retailprep.operators.schema import attribute_columns, conform
from retailprep.plans import product
from retailprep.session import scratch_path
from retailprep.sources import first_column, read_dictionary

from .fixtures import with_clause
from .registry import query
from .text_queries import robust

SOURCES = ("product_raw", "uda_raw", "uda_def", "warehouse_raw", "inventory_recent", "known_product")
ATTRIBUTES = ["Sex Department", "StoreDepartment", "SalesFloorSegmentQty", "Season", "Fabric / Type"]
CLEAN_ATTRIBUTES = ["sex_department", "storedepartment", "salesfloorsegmentqty", "fabric_type"]
GROUPS = [f"product_group_{i}_{p}" for i in range(1, 5) for p in ("description", "code")]

ACTIVE = """active AS (
    SELECT product_code FROM warehouse_raw WHERE product_code IS NOT NULL
    UNION SELECT product_code FROM inventory_recent UNION SELECT external_id FROM known_product)"""
PIVOT = """piv AS (
    SELECT product_code,
        min(uda_value) FILTER (WHERE uda_description = 'Sex Department') AS sex_department,
        min(uda_value) FILTER (WHERE uda_description = 'StoreDepartment') AS storedepartment,
        min(uda_value) FILTER (WHERE uda_description = 'SalesFloorSegmentQty') AS salesfloorsegmentqty,
        min(uda_value) FILTER (WHERE uda_description = 'Fabric / Type') AS fabric_type
    FROM uda_raw JOIN uda_def USING (uda_code) GROUP BY product_code)"""
COLUMNS = [
    "product_code", "option_code", "size_code", "product_description", "brand", "product_group_1_code",
    "product_group_1_description", "product_group_2_code", "product_group_2_description", "product_group_3_code",
    "product_group_3_description", "product_group_4_code", "product_group_4_description", "model_code", "color_code",
    "price_with_tax", "tax_rate", "cogs", "currency", "season",
]
CATALOGUE = f"""catalogue AS (
    SELECT {', '.join(COLUMNS)} FROM (
        SELECT *, row_number() OVER (PARTITION BY product_code
                  ORDER BY {', '.join(c + ' NULLS LAST' for c in COLUMNS[1:])}) AS rn
        FROM product_raw WHERE trim(product_code) <> '' AND product_group_1_code <> '-1'
            AND product_code IN (SELECT product_code FROM active)) WHERE rn = 1)"""


def crc32(c: str) -> str:
    """CRC-32 of ASCII text, bit by bit: a byte is xor-ed in, then eight shifts follow."""
    steps = f"flatten(list_transform(string_split({c}, ''), lambda ch: [ord(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    fold = "lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END"
    return f"""CASE WHEN {c} = '' THEN 0 ELSE
        xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), {fold}), 4294967295) END"""


def dominant_sql(name: str, source: str, parent: str, columns: list[str]) -> str:
    """CTE ``<name>``: most frequent non-NULL value per parent and column, ties to the smallest."""
    parts = []
    for c in columns:
        parts.append(f"""(SELECT {parent}, {c} AS dom_{c} FROM (
            SELECT {parent}, {c}, row_number() OVER (PARTITION BY {parent} ORDER BY count(*) DESC, {c}) AS rn
            FROM {source} WHERE {c} IS NOT NULL AND {parent} IS NOT NULL GROUP BY {parent}, {c}) WHERE rn = 1)""")
    joined = f"(SELECT DISTINCT {parent} FROM {source} WHERE {parent} IS NOT NULL) p"
    for i, part in enumerate(parts):
        joined += f" LEFT JOIN {part} d{i} USING ({parent})"
    return f"{name} AS (SELECT * FROM {joined})"


def active(t):
    known = t.known_product.select(F.col("external_id").alias("product_code"))
    return active_keys("product_code", t.warehouse_raw, t.inventory_recent, known)


def known(t):
    return t.known_product.select(F.col("external_id").alias("product_code"))


def feed(t, **options):
    return product.product_feed(
        t.product_raw, t.uda_raw, t.uda_def, active(t), ATTRIBUTES, settled=True, **options
    )


@query(
    "active_products",
    with_clause(*SOURCES, more=ACTIVE)
    + """SELECT product_code, size_code, 1 AS is_active FROM product_raw
        WHERE product_code IN (SELECT product_code FROM active)""",
)
def _(t):
    # the dictionary as it lies in storage: one folder per snapshot
    path = scratch_path(t.spark, "dictionaries/product")
    t.known_product.write.parquet(f"{path}/2026-03-01")
    t.known_product.write.parquet(f"{path}/2026-03-02")
    dictionary = read_dictionary(t.spark, path)
    codes = dictionary.select(first_column(dictionary, "product_code", "external_id", "code").alias("product_code"))
    keys = active_keys("product_code", t.warehouse_raw, t.inventory_recent, codes)
    return keep_active(t.product_raw, keys, "product_code").select("product_code", "size_code", "is_active")


@query(
    "dictionary_schemas",
    """SELECT DISTINCT code AS product_code, value FROM (
        SELECT CAST(p_partkey AS VARCHAR) AS code, CAST(p_retailprice AS DECIMAL(15,2)) AS value FROM part WHERE p_size <= 10
        UNION ALL SELECT 'X' || CAST(p_partkey AS VARCHAR), CAST(p_retailprice + 1 AS DECIMAL(15,2)) FROM part WHERE p_size BETWEEN 11 AND 20
        UNION ALL SELECT CAST(p_partkey AS VARCHAR), NULL FROM part WHERE p_size BETWEEN 21 AND 30
        UNION ALL SELECT CASE WHEN p_size % 2 = 0 THEN CAST(p_partkey AS VARCHAR) END, CAST(p_size AS DECIMAL(15,2))
            FROM part WHERE p_size > 30)""",
)
def _(t):
    # four snapshots, each under the names and types of its day
    path = scratch_path(t.spark, "dictionaries/known")
    for day, shape in (
        ("2026-03-01", "SELECT CAST(p_partkey AS STRING) AS Product_Code, p_name AS code, p_retailprice AS value FROM {part} WHERE p_size <= 10"),
        (
            "2026-03-02",
            "SELECT 'X' || CAST(p_partkey AS STRING) AS external_id, CAST(p_retailprice + 1 AS STRING) AS price FROM {part}"
            " WHERE p_size BETWEEN 11 AND 20",
        ),
        ("2026-03-03", "SELECT p_partkey AS code FROM {part} WHERE p_size BETWEEN 21 AND 30"),
        # its own product_code counts, also where it is NULL and another name is not
        (
            "2026-03-04",
            "SELECT CASE WHEN p_size % 2 = 0 THEN p_partkey END AS product_code, p_name AS external_id, p_size AS value FROM {part}"
            " WHERE p_size > 30",
        ),
    ):
        t.spark.sql(shape, part=t.part).write.parquet(f"{path}/{day}")
    columns = {**product.DICTIONARY, "value": (("value", "price"), "decimal(15,2)")}
    return read_dictionary(t.spark, path, columns, absent="null").distinct()


@query(
    "product_delta",
    with_clause("product_raw", "known_product")
    + """SELECT product_code, size_code, season FROM product_raw r
        WHERE NOT EXISTS (SELECT 1 FROM known_product k WHERE k.external_id = r.product_code)""",
)
def _(t):
    return new_rows(t.product_raw, known(t), ["product_code"]).select("product_code", "size_code", "season")


@query(
    "attribute_pivot",
    with_clause("product_raw", "uda_raw", "uda_def", more=PIVOT)
    + f"""SELECT r.product_code, r.size_code, r.season, {', '.join(CLEAN_ATTRIBUTES)}
        FROM product_raw r LEFT JOIN piv USING (product_code)""",
)
def _(t):
    # without given names Spark looks them up itself
    pivoted = pivot_attributes(t.uda_raw, t.uda_def, "product_code", "uda_code", "uda_description", "uda_value")
    products = t.product_raw.select("product_code", "size_code", "season")
    joined = join_attributes(products, pivoted, "product_code")
    extra = attribute_columns(joined, ATTRIBUTES, products.columns)
    return joined.select(*products.columns, *extra)


@query(
    "dedupe_product",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_shipdate AS DATE) AS l_shipdate FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate) AS rn
        FROM lineitem) WHERE rn = 1""",
)
def _(t):
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_shipdate").cast("date").alias("l_shipdate")
    )
    return dedupe(rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_shipdate"])


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def _(t):
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query(
    "parent_conflicts",
    with_clause("product_raw")
    + f"""SELECT option_code, {', '.join(f'count(DISTINCT {c}) AS n_{c}' for c in GROUPS)} FROM product_raw
        GROUP BY option_code HAVING {' OR '.join(f'count(DISTINCT {c}) > 1' for c in GROUPS)}""",
)
def _(t):
    return find_conflicts(t.product_raw, "option_code", GROUPS)


@query(
    "parent_consensus",
    with_clause("product_raw", more=dominant_sql("dom", "product_raw", "option_code", GROUPS))
    + f"""SELECT r.product_code, r.option_code, r.size_code, r.brand, {', '.join(f'COALESCE(dom_{c}, {c}) AS {c}' for c in GROUPS)}
        FROM product_raw r LEFT JOIN dom USING (option_code)""",
)
def parent_consensus(t):
    rows = t.product_raw.select("product_code", "option_code", "size_code", "brand", *GROUPS)
    return consensus(rows, "option_code", GROUPS)


# Most children know nothing of the first two groups: empty rows are the most frequent ones.
GAPS = f"""SELECT product_code, option_code, size_code, brand, {', '.join(
    f"CASE WHEN right(product_code, 1) IN ('1', '2', '3', '4', '5', '6') THEN NULL ELSE {c} END AS {c}" for c in GROUPS)}
    FROM """


@query(
    "parent_consensus_tuple",
    with_clause("product_raw")
    + f""", gaps AS ({GAPS} product_raw), best AS (SELECT * EXCLUDE (rn) FROM (
            SELECT option_code, {' AND '.join(f'{c} IS NULL' for c in GROUPS)} AS empty, {', '.join(f'{c} AS t_{c}' for c in GROUPS)},
                row_number() OVER (PARTITION BY option_code
                    ORDER BY {' AND '.join(f'{c} IS NULL' for c in GROUPS)}, count(*) DESC,
                        {' + '.join(f'CAST({c} IS NULL AS INT)' for c in GROUPS)}, {', '.join(f'{c} NULLS FIRST' for c in GROUPS)}) AS rn
            FROM gaps GROUP BY option_code, {', '.join(GROUPS)}) WHERE rn = 1)
        SELECT r.product_code, r.size_code, r.brand, {', '.join(f'CASE WHEN empty THEN {c} ELSE t_{c} END AS {c}' for c in GROUPS)}
        FROM gaps r JOIN best USING (option_code)""",
)
def _(t):
    rows = t.spark.sql(GAPS + "{raw}", raw=t.product_raw)
    return consensus(rows, "option_code", GROUPS, as_tuple=True).drop("option_code")


LEVEL5 = "concat_ws(' ', trim(sex_department), trim(product_group_4_description))"


@query(
    "level5_category",
    with_clause("product_raw", "uda_raw", "uda_def", more=PIVOT)
    + f""", named AS (SELECT r.product_code, r.size_code, {LEVEL5} AS category_level5_name
            FROM product_raw r LEFT JOIN piv USING (product_code)),
        codes AS (SELECT name, lpad(CAST({crc32('name')} AS VARCHAR), 10, '0') || '_l5' AS category_level5_code
            FROM (SELECT DISTINCT category_level5_name AS name FROM named))
        SELECT n.*, c.category_level5_code FROM named n JOIN codes c ON c.name = n.category_level5_name""",
)
def _(t):
    pivoted = pivot_attributes(
        t.uda_raw, t.uda_def, "product_code", "uda_code", "uda_description", "uda_value", ATTRIBUTES
    )
    products = t.product_raw.select("product_code", "size_code", "product_group_4_description")
    levelled = product.with_level5(join_attributes(products, pivoted, "product_code"))
    return levelled.select("product_code", "size_code", "category_level5_name", "category_level5_code")


CONFORMED = [
    "product_code AS external_id", "product_code AS code", "option_code AS name", "'ST' AS unit_of_measure_code",
    "option_code AS parent_product_code", "product_description AS parent_product_name",
    "DATE '2023-01-01' AS start_selling_date", "brand AS product_brand_name", "brand AS product_brand_code",
]
TAIL = "model_code, size_code, color_code"


@query(
    "conform_product",
    with_clause("product_raw")
    + f"""SELECT {', '.join(CONFORMED)}, TRY_CAST(replace(tax_rate, ',', '~') AS DECIMAL(7,4)) AS tax_rate,
            CAST(NULL AS INTEGER) AS is_active,
            {', '.join(f'product_group_{i}_description AS category_level{i}_name, product_group_{i}_code AS category_level{i}_code' for i in range(1, 5))},
            CAST(NULL AS VARCHAR) AS category_level5_name, CAST(NULL AS VARCHAR) AS category_level5_code, {TAIL},
            CAST(NULL AS DECIMAL(10,2)) AS price_with_tax, season, CAST(NULL AS DECIMAL(10,2)) AS cogs, currency,
            CAST(NULL AS VARCHAR) AS sku, CAST(NULL AS VARCHAR) AS store_department,
            CAST(NULL AS INTEGER) AS salesfloor_segment, CAST(NULL AS INTEGER) AS stockroom_segment
        FROM product_raw""",
)
def _(t):
    return conform(t.product_raw, product.PRODUCT)


VOTED = [*GROUPS, "category_level5_name", "category_level5_code"]
PRODUCT_FEED = (
    with_clause(
        *SOURCES,
        more=",\n".join(
            [
                ACTIVE,
                CATALOGUE,
                PIVOT,
                f"""wide AS (
            SELECT c.* EXCLUDE ({', '.join(f'product_group_{i}_code' for i in range(1, 5))}),
                {', '.join(f"c.product_group_{i}_code || '_l{i}' AS product_group_{i}_code" for i in range(1, 5))},
                piv.* EXCLUDE (product_code), {LEVEL5} AS category_level5_name
            FROM catalogue c LEFT JOIN piv ON piv.product_code = c.product_code)""",
                f"""codes AS (SELECT name, lpad(CAST({crc32('name')} AS VARCHAR), 10, '0') || '_l5' AS category_level5_code
            FROM (SELECT DISTINCT category_level5_name AS name FROM wide))""",
                "coded AS (SELECT w.*, x.category_level5_code FROM wide w JOIN codes x ON x.name = w.category_level5_name)",
                dominant_sql("dom", "coded", "option_code", VOTED),
                f"""agreed AS (SELECT c.* EXCLUDE ({', '.join(VOTED)}), {', '.join(f'COALESCE(dom_{c}, {c}) AS {c}' for c in VOTED)}
            FROM coded c LEFT JOIN dom USING (option_code))""",
                f"""feed AS (SELECT {', '.join(CONFORMED)}, {robust('tax_rate', 7, 4)} AS tax_rate, 1 AS is_active,
            {', '.join(f'product_group_{i}_description AS category_level{i}_name, product_group_{i}_code AS category_level{i}_code' for i in range(1, 5))},
            category_level5_name, category_level5_code, {TAIL}, {robust('price_with_tax', 10, 2)} AS price_with_tax,
            season, {robust('cogs', 10, 2)} AS cogs, currency, option_code || '_' || size_code AS sku,
            storedepartment AS store_department, TRY_CAST(salesfloorsegmentqty AS INTEGER) AS salesfloor_segment,
            CAST(NULL AS INTEGER) AS stockroom_segment, {', '.join(CLEAN_ATTRIBUTES)} FROM agreed)""",
            ]
        ),
    )
)


@query("product_feed", PRODUCT_FEED + "SELECT * FROM feed")
def product_feed(t):
    return feed(t)


@query(
    "product_feed_delta",
    PRODUCT_FEED + "SELECT * FROM feed WHERE external_id NOT IN (SELECT external_id FROM known_product)",
)
def _(t):
    return feed(t, known=known(t))


@query(
    "season_stats",
    with_clause(*SOURCES, more=f"{ACTIVE}, {CATALOGUE}")
    + """, dated AS (SELECT season, CAST(2000 + TRY_CAST(nullif(regexp_extract(upper(trim(season)), '^(SS|AW)([0-9]{2})$', 2), '')
                AS INTEGER) AS INTEGER) AS season_year
            FROM catalogue WHERE product_code NOT IN (SELECT external_id FROM known_product))
        SELECT season, season_year, COALESCE(season_year < 2025, false) AS is_old, count(*) AS products
        FROM dated GROUP BY ALL""",
)
def _(t):
    return product.season_stats(product.active_catalogue(t.product_raw, active(t)), known(t), 2026)


@query(
    "catalogue_stats",
    with_clause(*SOURCES, more=f"{ACTIVE}, {CATALOGUE}")
    + """, keyed AS (SELECT * FROM product_raw WHERE trim(product_code) <> ''),
        act AS (SELECT * FROM keyed WHERE product_code IN (SELECT product_code FROM active)),
        n AS (SELECT (SELECT count(*) FROM keyed) AS catalogue, (SELECT count(*) FROM act) AS active_rows,
            (SELECT count(*) FROM act WHERE product_group_1_code IS NULL OR product_group_1_code = '-1') AS technical_rows,
            (SELECT count(*) FROM catalogue) AS active_products,
            (SELECT count(*) FROM catalogue WHERE product_code NOT IN (SELECT external_id FROM known_product)) AS new_products)
        SELECT catalogue, active_rows, technical_rows, active_rows - technical_rows - active_products AS duplicate_rows,
            active_products, new_products, catalogue - active_products AS skipped FROM n""",
)
def _(t):
    return product.catalogue_stats(t.product_raw, active(t), known(t))


QUALITY_LINES = " UNION ALL ".join(
    f"""SELECT 'blank' AS "check", '{c}' AS "column", CASE WHEN b_{c} > 0 THEN 'WARN' ELSE 'INFO' END AS level,
        b_{c} AS rows, total FROM counts"""
    for c in product.REQUIRED
)
SHARE = "CAST(CAST((rows * 200000 + total) // (2 * total) AS DECIMAL(18,0)) / 1000 AS DECIMAL(7,3)) AS share"


@query(
    "quality_report",
    with_clause("product_raw")
    + f""", counts AS (SELECT count(*) AS total,
            {', '.join(f"count(*) FILTER (WHERE COALESCE(trim({c}), '') = '') AS b_{c}" for c in product.REQUIRED)}
            FROM product_raw),
        lines AS (SELECT 'rows' AS "check", '*' AS "column", 'INFO' AS level, total AS rows, total FROM counts
            UNION ALL {QUALITY_LINES})
        SELECT "check", "column", level, rows, {SHARE} FROM lines""",
)
def _(t):
    return product.product_report(t.product_raw)


@query(
    "department_report",
    with_clause(*SOURCES, more=f"{ACTIVE}, {CATALOGUE}, {PIVOT}")
    + f""", counts AS (SELECT count(*) AS total,
            count(*) FILTER (WHERE COALESCE(trim(storedepartment), '') IN ('', '0')) AS missing
            FROM catalogue c LEFT JOIN piv USING (product_code)),
        lines AS (SELECT 'rows' AS "check", '*' AS "column", 'INFO' AS level, total AS rows, total FROM counts
            UNION ALL SELECT 'no_department', 'store_department', CASE WHEN missing > 0 THEN 'WARN' ELSE 'INFO' END,
                missing, total FROM counts)
        SELECT "check", "column", level, rows, {SHARE} FROM lines""",
)
def _(t):
    enriched, _ = product.enriched_products(t.product_raw, t.uda_raw, t.uda_def, active(t), ATTRIBUTES, settled=True)
    return product.department_report(enriched)
