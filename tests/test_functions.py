"""Column functions on dirty values; the session runs in ANSI mode, so nothing may raise."""

import hashlib
import zlib
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailprep import functions as R


def column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_ansi_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


@pytest.mark.parametrize(
    ("text", "robust", "strict"),
    [
        ("12,5", "12.50", "12.50"),
        ('"12,50"', "12.50", "12.50"),
        ("1 234,56", "1234.56", None),
        ("99,99 zl", "99.99", None),
        ("1.234,56", None, None),
        ("12,345", "12.35", "12.35"),
        ("-3", "-3.00", "-3.00"),
        ("1E3", "13.00", "1000.00"),
        ("123456789012345", None, None),
        ("-", None, None),
        ("", None, None),
        (None, None, None),
        (" 7,1 ", "7.10", "7.10"),
    ],
)
def test_parse_decimal(spark, text, robust, strict):
    got = spark.createDataFrame([(text,)], "s string").select(
        R.parse_decimal("s", 10, 2), R.parse_decimal("s", 10, 2, strict=True)
    )
    want = tuple(None if v is None else Decimal(v) for v in (robust, strict))
    assert tuple(got.first()) == want


DATES = [
    "2024-01-02",
    "2024-01-02 10:00:00",
    "2024-01-02 25:00:00",
    "02.01.2024",
    "31.04.2024",
    "2024-13-01",
    "2024-1-2",
    " 2024-01-02 ",
    "soon",
    "",
    None,
]


def test_parse_date_in_formats(spark):
    got = column(spark, DATES, R.parse_date("s", R.DATE_FORMATS))
    day = date(2024, 1, 2)
    assert got == [day, day, None, day, None, None, None, None, None, None, None]


def test_parse_date_equals_parsing_by_format(spark):
    by_format = F.coalesce(*[F.try_to_date("s", f) for f in R.DATE_FORMATS])
    assert column(spark, DATES, R.parse_date("s", R.DATE_FORMATS)) == column(spark, DATES, by_format)


def test_parse_date_formats_of_one_shape_keep_their_order(spark):
    texts = ["02.01.2024", "12.31.2024", "31.12.2024"]
    got = column(spark, texts, R.parse_date("s", ["dd.MM.yyyy", "MM.dd.yyyy"]))
    assert got == [date(2024, 1, 2), date(2024, 12, 31), date(2024, 12, 31)]


def test_parse_date_other_formats(spark):
    assert column(spark, ["2.1.2024", "x"], R.parse_date("s", ["d.M.yyyy"])) == [date(2024, 1, 2), None]


def test_parse_iso_date(spark):
    got = column(spark, ["2024-01-02", "2024-01-02 10:00:00", "2024-13-01", "x", None], R.parse_date("s"))
    assert got == [date(2024, 1, 2), date(2024, 1, 2), None, None, None]


def test_blanks(spark):
    values = [None, "", "  ", " a "]
    assert column(spark, values, R.blank_to_null("s")) == [None, None, None, "a"]
    assert column(spark, values, R.is_blank("s")) == [True, True, True, False]


def test_country(spark):
    values = [None, "", "  ", " po ", "SVK", "de", "Czechia"]
    assert column(spark, values, R.normalise_country("s")) == ["Eshop"] * 3 + ["PL", "SK", "DE", "CZ"]


def test_zone(spark):
    assert column(spark, ["PLREGF", " PLREGA ", "F", "", None], R.strip_last("s")) == ["PLREG", "PLREG", "", "", None]


def test_class_flags(spark):
    values = ["ZAMKNIETE", "OTWARTE", None]
    assert column(spark, values, R.flag_differs("s", R.CLOSED)) == [0, 1, 0]
    assert column(spark, values, R.flag_equals("s", R.CLOSED)) == [1, 0, 0]


def test_map_value(spark):
    assert column(spark, ["PL", "XX", None], R.map_value("s", R.COUNTRY_NAMES)) == ["Polska", "XX", None]
    assert column(spark, ["PL"], R.map_value("s", {})) == ["PL"]


def test_stable_code(spark):
    def expected(text):
        return str(int(hashlib.sha256(text.encode()).hexdigest()[:15], 16) % 10**10).zfill(10)

    values = ["Polska", "Polska|SPORT", "", "zażółć"]
    assert column(spark, values, R.stable_code("s")) == [expected(v) for v in values]
    assert column(spark, [None], R.stable_code("s")) == [None]


def test_path_code_skips_nulls_unless_told(spark):
    df = spark.createDataFrame([("A", None, "B"), ("A", "B", None)], "a string, b string, c string")
    cols = [F.col("a"), F.col("b"), F.col("c")]
    skipped = [r[0] for r in df.select(R.path_code(cols)).collect()]
    kept = [r[0] for r in df.select(R.path_code(cols, null_token="?")).collect()]
    assert skipped[0] == skipped[1]
    assert kept[0] != kept[1]


def test_crc_code(spark):
    values = ["GIRL TROUSERS CAS", "", "żółć"]
    want = [str(zlib.crc32(v.encode())).zfill(10) + "_l5" for v in values]
    assert column(spark, values, R.crc_code("s", "_l5")) == want


def test_season(spark):
    values = ["SS22", " aw25", "MM", "SS2", "", None]
    assert column(spark, values, R.season_year("s")) == [2022, 2025, None, None, None, None]
    assert column(spark, values, R.is_old_season("s", 2026)) == [True, False, False, False, False, False]


def test_level5_name(spark):
    df = spark.createDataFrame([(" GIRL ", "CAS "), (None, "CAS"), ("GIRL", None)], "a string, b string")
    assert [r[0] for r in df.select(R.level5_name("a", "b")).collect()] == ["GIRL CAS", "CAS", "GIRL"]
    assert df.select(R.level5_name(None, "b")).first()[0] == "CAS"


def test_sku_is_null_when_a_part_is(spark):
    df = spark.createDataFrame([("a", "S"), ("a", None)], "a string, b string")
    assert [r[0] for r in df.select(R.sku("a", "b")).collect()] == ["a_S", None]


def test_split_variant(spark):
    parent, size = R.split_variant("s")
    values = ["A-XX-13/35", "A/35,5/x", "A", None]
    assert column(spark, values, parent) == ["A-XX-13", "A", "A", None]
    assert column(spark, values, size) == ["35", "35,5/x", None, None]


def test_signed_and_market(spark):
    df = spark.createDataFrame([("S1", "PL", 2, True), ("S2", "PL", 2, False)], "s string, c string, q int, r boolean")
    got = df.select(R.signed("q", F.col("r")), R.market_code("s", "c", ["S1"])).collect()
    assert [tuple(r) for r in got] == [(-2, "Eshop"), (2, "PL")]


def test_dates_of_fixed_width_need_no_formatter(spark):
    texts = ["2024-02-29", "2023-02-29", "0000-01-01", "2024-02-03 23:59:59", "2024-02-03 24:00:00", "2024-02-03 10:60:00", "31.12.2024", "31.11.2024", "01.01.0000", "2024-2-3", " 2024-02-03", None]
    parsed = R.parse_date("s", R.DATE_FORMATS)
    by_format = F.coalesce(*[F.try_to_date("s", f) for f in R.DATE_FORMATS])
    assert column(spark, texts, parsed.cast("string")) == column(spark, texts, by_format.cast("string"))
    plan = spark.createDataFrame([("x",)], "s string").select(parsed)._jdf.queryExecution().optimizedPlan().toString()
    assert "gettimestamp" not in plan.lower()
