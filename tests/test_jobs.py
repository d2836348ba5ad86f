"""Jobs from delivered files to published feeds."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailprep.operators.quality import EmptyFeed
from retailprep.operators.schema import MissingColumns
from retailprep.plans import jobs, price
from retailprep.sources import read_feed


@pytest.fixture
def put(tmp_path):
    def write(name, *lines):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write


def records(df):
    return [r.asDict() for r in df.collect()]


def report(df):
    return sorted(tuple(r) for r in df.collect())


def test_stores(spark, put, tmp_path):
    stores = put(
        "store.csv",
        "Store_Code;store_description;country;class;first_price;segment;building_type;gross_area;opening_date;mos_attribute_2",
        "PL1;One; po ;OTWARTE;PLREGF;SPORT;Regular;100.5;;B",
        "PL2;Two;Poland;ZAMKNIETE;PLREGA;; ;bad;2020-01-01;",
        "SK1;Three;SVK;;SKREGF;SPORT;Outlet;;;",
        "DE1;Four;;OTWARTE;DEREGF;SPORT;Outlet;;;",
        ";Five;de;OTWARTE;DEREGF;SPORT;Outlet;;;",
    )
    communities = put("community.csv", "store_code;community_id", " PL1 ;7", "PL2;x")
    calendar = put(
        "calendar.csv",
        "store_code;opening_date;closing_date",
        "PL1;2019-05-01;2019-09-01",
        "PL1;2021-05-01;",
        "PL2;2018-05-01;2018-06-01",
        "SK1;2024-13-01;",
    )
    full = str(tmp_path / "out" / "store")
    reports = jobs.import_stores(spark, stores, full, None, communities, calendar, force_active=["PL2"])
    out = {r["code"]: r for r in records(read_feed(spark, full))}
    assert sorted(out) == ["PL1", "PL2", "SK1"]
    assert out["PL1"]["country_symbol"] == "PL"
    assert out["PL1"]["market_code"] == "PLREG"
    assert out["PL1"]["opening_date"] == "2021-05-01"
    assert out["PL1"]["community_id"] == "7"
    assert out["PL1"]["surface_area"] == "100.50"
    assert out["PL1"]["mos_attribute_2"] == "B"
    assert "mos_attribute_1" not in out["PL1"]
    assert (out["PL2"]["is_active"], out["PL2"]["is_closed"]) == ("1", "0")
    assert (out["PL2"]["opening_date"], out["PL2"]["closing_date"]) == ("2020-01-01", "2018-06-01")
    assert (out["PL2"]["category_level2_name"], out["PL2"]["category_level3_name"]) == (None, None)
    assert out["PL2"]["category_level1_code"] == out["PL2"]["category_level2_code"]
    assert (out["SK1"]["is_active"], out["SK1"]["is_closed"]) == ("0", "0")
    assert out["SK1"]["category_level1_name"] == "Slowacja"
    assert out["SK1"]["opening_date"] is None
    assert [tuple(r) for r in reports["totals"].collect()] == [(4, 2, 0, 1)]
    assert ("no_country", "country", "WARN", 1, Decimal("20.000")) in report(reports["quality"])


def test_stores_without_optional_files_and_columns(spark, put, tmp_path):
    stores = put("store.csv", "store_code;store_description;country", "A;One;PL")
    full = str(tmp_path / "store")
    reports = jobs.import_stores(
        spark, stores, full, communities=str(tmp_path / "none.csv"), calendar=str(tmp_path / "none2.csv")
    )
    assert [tuple(r) for r in reports["totals"].collect()] == [(1, None, None, 0)]
    (row,) = records(read_feed(spark, full))
    assert (row["market_code"], row["is_active"], row["community_id"]) == ("PL", None, None)
    with pytest.raises(MissingColumns):
        jobs.import_stores(spark, put("bad.csv", "store_code", "A"), full)
    with pytest.raises(EmptyFeed):
        jobs.import_stores(spark, put("empty.csv", "store_code;store_description"), full)


PRODUCT_HEADER = (
    "product_code;option_code;size_code;product_description;brand;product_group_1_code;product_group_1_description;"
    "product_group_4_code;product_group_4_description;price_with_tax;tax_rate;season"
)


def test_products(spark, put, tmp_path):
    products = put(
        "product.csv",
        PRODUCT_HEADER,
        "1;OPT;S;Item;BR;G1;All;K;TROUSERS;1 234,56 zl;23,00;SS22",
        "2;OPT;M;Item;BR;G1;All;K;TROUSERS;99,9;8;SS26",
        "3;OPT;L;Item;BR;G1;All;K;TROUSERS;;;",
        "3;OPT;L;Item again;BR;G1;All;K;TROUSERS;;;",
        "4;TECH;S;Item;BR;-1;All;K;X;;;",
        "5;OTHER;S;Item;BR;G1;All;K;X;;;",
        " ;OTHER;S;Item;BR;G1;All;K;X;;;",
    )
    attributes = put(
        "product_uda.csv",
        "product_code;uda_code;uda_value",
        "1;U1;GIRL",
        "2;U1;GIRL",
        "3;U1;NONE",
        "1;U2;D1",
        "1;U3;5",
        "1;U4;ignored",
    )
    definitions = put(
        "uda.csv", "uda_code;uda_description", "U1;Sex Department", "U2;StoreDepartment", "U3;SalesFloorSegmentQty", "U4;Season"
    )
    warehouse = put("wh.csv", "product_code|inventory", "1|1", "4|1")
    put("stock/inventory_2026_03_14.csv", "product_code", "5")
    put("stock/inventory_2026_03_15.csv", "product_code", "2")
    spark.createDataFrame([("3",)], "code string").write.parquet(str(tmp_path / "dict" / "2026-03-14"))
    spark.createDataFrame([("3",)], "code string").write.parquet(str(tmp_path / "dict" / "2026-03-15"))
    arguments = (spark, products, attributes, definitions, warehouse, str(tmp_path / "stock"), str(tmp_path / "dict"), 2026)
    full, sample = str(tmp_path / "full"), str(tmp_path / "sample")
    reports = jobs.import_products(*arguments, full, sample, mode="BOTH")
    out = {r["code"]: r for r in records(read_feed(spark, full))}
    assert sorted(out) == ["1", "2", "3"]
    first = out["1"]
    assert first["price_with_tax"] == "1234.56"
    assert first["tax_rate"] == "23.0000"
    assert first["sku"] == "OPT_S"
    assert first["category_level1_code"] == "G1_l1"
    assert first["store_department"] == first["storedepartment"] == "D1"
    assert first["salesfloor_segment"] == "5"
    assert first["season"] == "SS22"
    assert first["sex_department"] == "GIRL"
    # the odd sibling takes the majority's category but keeps its own attribute
    assert out["3"]["sex_department"] == "NONE"
    assert {r["category_level5_name"] for r in out.values()} == {"GIRL TROUSERS"}
    assert len({r["category_level5_code"] for r in out.values()}) == 1
    assert out["3"]["parent_product_name"] == "Item"
    assert read_feed(spark, sample).count() == 3
    stats = reports["stats"].first().asDict()
    assert stats == {
        "catalogue": 6,
        "active_rows": 5,
        "technical_rows": 1,
        "duplicate_rows": 1,
        "active_products": 3,
        "new_products": 2,
        "skipped": 3,
    }
    assert report(reports["duplicates"].filter("product_code = '3'")) == [("3", "L", 2)]
    assert report(reports["seasons"]) == [("SS22", 2022, True, 1), ("SS26", 2026, False, 1)]
    assert ("no_department", "store_department", "WARN", 2, Decimal("66.667")) in report(reports["departments"])
    delta = str(tmp_path / "delta")
    jobs.import_products(*arguments, delta, kind="DELTA")
    assert sorted(r["code"] for r in records(read_feed(spark, delta))) == ["1", "2"]


def test_known_products_of_every_schema(spark, tmp_path):
    for day, column in (("1", "product_code"), ("2", "external_id"), ("3", "code")):
        spark.createDataFrame([(day,), ("9",)], f"{column} string").write.parquet(str(tmp_path / "dict" / day))
    assert report(jobs.known_products(spark, str(tmp_path / "dict"))) == [("1",), ("2",), ("3",), ("9",)]
    assert jobs.known_products(spark, str(tmp_path / "none")).isEmpty()


def test_first_product_import_has_no_dictionary(spark, put, tmp_path):
    products = put("product.csv", PRODUCT_HEADER, "1;OPT;S;Item;BR;G1;All;K;TROUSERS;1;1;SS26")
    attributes = put("product_uda.csv", "product_code;uda_code;uda_value", "1;U1;GIRL")
    definitions = put("uda.csv", "uda_code;uda_description", "U1;Sex Department")
    warehouse = put("wh.csv", "product_code", "1")
    full = str(tmp_path / "full")
    jobs.import_products(
        spark, products, attributes, definitions, warehouse, str(tmp_path / "no"), str(tmp_path / "nope"), 2026, full, kind="DELTA"
    )
    assert [r["code"] for r in records(read_feed(spark, full))] == ["1"]


@pytest.fixture
def price_files(spark, put, tmp_path):
    header = "price_date|product_agg_level_code|store_agg_level_code|price_with_tax|currency"
    base = put(
        "price.csv",
        header,
        "2024-01-01| 1 |PLREGF|10,00|PLN",
        "2024-01-01|1|PLREGA|9,50|PLN",
        "05.01.2024|1|PLREGF|8|PLN",
        "2024-01-09 12:00:00|1|PLREGF|7,005|PLN",
        "2024-13-01|1|PLREGF|1|PLN",
        "2024-01-02|1|PLREGF|0,00|PLN",
        "2024-01-01|1|CLOSEDF|1|PLN",
        "2024-01-01|9|PLREGF|1|PLN",
    )
    retail = put("retail_price.csv", header, "2024-01-01|1|PLREGF|5|PLN", "2024-01-01|2|PLREGF|6|PLN")
    stores = put(
        "store.csv",
        "store_code;class;first_price;actual_price",
        "S1;;PLREGF;PLREGF",
        "S2;OTWARTE;PLREGA;",
        "S3;ZAMKNIETE;CLOSEDF;CLOSEDF",
    )
    spark.createDataFrame([("1",), ("2 ",), ("1",)], "code string").write.parquet(str(tmp_path / "products" / "a"))
    return base, retail, stores, str(tmp_path / "products")


def test_prices(spark, price_files, tmp_path):
    full, sample = str(tmp_path / "full"), str(tmp_path / "sample")
    reports = jobs.import_prices(spark, *price_files, full, sample, mode="BOTH")
    out = read_feed(spark, full)
    assert sorted({r["name_key"] for r in records(out)}) == ["Cennik_bazowy_PLREG", "Cennik_promocyjny_PLREG"]
    columns = ("name", "price_type_id", "market_code", "product_code", "value", "start_date", "end_date", "priority")
    got = sorted(tuple(r[c] for c in columns) for r in records(out))
    base, promo = ("Cennik_bazowy_PLREG", "100", "PLREG"), ("Cennik_promocyjny_PLREG", "200", "PLREG")
    assert got == [
        (*base, "1", "7.01", "2024-01-09 00:00:00", None, "1"),
        (*base, "1", "8.00", "2024-01-05 00:00:00", "2024-01-08 00:00:00", "1"),
        (*base, "1", "9.50", "2024-01-01 00:00:00", "2024-01-04 00:00:00", "1"),
        (*promo, "1", "5.00", "2024-01-01 00:00:00", None, "2"),
        (*promo, "2", "6.00", "2024-01-01 00:00:00", None, "2"),
    ]
    assert read_feed(spark, sample).count() == 5
    assert report(reports["totals"]) == [(5, 2)]
    assert report(reports["lists"]) == [("Cennik_bazowy_PLREG", 3, 1), ("Cennik_promocyjny_PLREG", 2, 2)]


def test_price_delta(spark, price_files, tmp_path):
    first = str(tmp_path / "first")
    jobs.import_prices(spark, *price_files, first)
    delivered = read_feed(spark, first).drop("name_key").filter("value <> '5.00'")
    # one known row had no end when it was delivered
    known = delivered.withColumn("end_date", F.when(F.col("value") != "8.00", F.col("end_date")))
    known.write.parquet(str(tmp_path / "prices" / "2024-01-09"))
    second = str(tmp_path / "second")
    jobs.import_prices(spark, *price_files, second, price_dictionary=str(tmp_path / "prices"))
    got = sorted((r["value"], r["priority"]) for r in records(read_feed(spark, second)))
    assert got == [("5.00", "2"), ("8.00", "1")]
    third = str(tmp_path / "third")
    jobs.import_prices(spark, *price_files, third, price_dictionary=str(tmp_path / "none"))
    assert read_feed(spark, third).count() == 5


def test_price_options(spark, price_files):
    base, retail, stores, products = price_files
    frames = (read_feed(spark, base, "|"), read_feed(spark, retail, "|"), read_feed(spark, stores), spark.read.parquet(products + "/a"))
    feed = price.price_feed(*frames, zones=["PLREGA"], currency="EUR", min_date="2024-01-01")
    assert [(r["value"], r["currency_code"], r["priority"]) for r in feed.collect()] == [(Decimal("9.50"), "EUR", 1)]
    assert price.price_feed(*frames, min_date="2024-01-06").count() == 1


def test_store_stock(spark, put, tmp_path):
    header = "Store_Code ; product_code;inventory;inventory_date;stock_cost;currency"
    put("stock/inventory_2026_03_14.csv", header, "S1;old;1;2026-03-14;1;PLN")
    put(
        "stock/inventory_2026_03_15.csv",
        header,
        ' S1 ;1;"12,500";2026-03-15;"1,5";PLN',
        "S1;2;1 234,56;bad;x;PLN",
        "S1;3;0;2026-03-15;0;PLN",
        "S1;4;1E3;2026-03-15;0;PLN",
    )
    full = str(tmp_path / "full")
    jobs.import_store_stock(spark, str(tmp_path / "stock"), full)
    out = {r["product_code"]: r for r in records(read_feed(spark, full))}
    assert list(out["1"].values()) == ["2026-03-15", "S1", "1", "12.500", "ST", "1.50", "PLN"]
    assert (out["2"]["amount"], out["2"]["date_point_of_sale_level"], out["2"]["stock_cost"]) == (None, None, None)
    assert (out["3"]["amount"], out["4"]["amount"]) == ("0.000", "1000.000")
    jobs.import_store_stock(spark, str(tmp_path / "stock"), full, drop_zero=True)
    assert sorted(r["product_code"] for r in records(read_feed(spark, full))) == ["1", "4"]
    jobs.import_store_stock(spark, str(tmp_path / "stock"), full, file_mode="MANUAL", name="inventory_2026_03_14.csv")
    assert [r["product_code"] for r in records(read_feed(spark, full))] == ["old"]


def test_warehouse_stock(spark, tmp_path):
    path = tmp_path / "wh.csv"
    path.write_bytes("﻿warehouse_code |product_code|inventory|inventory_warehouse_date\nW1|1|2,5|2026-03-15\nW1||x|\n".encode())
    full = str(tmp_path / "full")
    reports = jobs.import_warehouse_stock(spark, str(path), full)
    out = sorted((list(r.values()) for r in records(read_feed(spark, full))), key=str)
    assert out == [["2026-03-15", "W1", "1", "2.500", "ST"], [None, "W1", None, None, "ST"]]
    assert report(reports["blanks"]) == [
        ("inventory", 2, 1, Decimal("50.000")),
        ("inventory_warehouse_date", 2, 1, Decimal("50.000")),
        ("product_code", 2, 1, Decimal("50.000")),
        ("warehouse_code", 2, 0, Decimal("0.000")),
    ]


def test_inbound(spark, put, tmp_path):
    orders = put(
        "orders.csv",
        "destination_code|product_code|quantity_ordered|estimated_arrival_date",
        " S1 |1|2,5|2026-04-01",
        " |1|1|2026-04-01",
        "S1|2|1|",
    )
    transit = put(
        "transit.csv", "destination_code|product_code|quantity|estimated_arrival_date", "S2|3|x|2026-04-02 10:00:00", "S2||1|soon"
    )
    full = str(tmp_path / "full")
    reports = jobs.import_inbound(spark, orders, transit, full)
    out = sorted(list(r.values()) for r in records(read_feed(spark, full)))
    assert out == [["S1", "1", "2.500", "ST", "2026-04-01"], ["S2", "3", None, "ST", "2026-04-02"]]
    assert dict(report(reports["volume"])) == {"total": 5, "blank_key": 2, "no_date": 1, "kept": 2}


def test_sales(spark, put, price_files, tmp_path):
    base, retail, _, _ = price_files
    stores = put("stores.csv", "store_code;country;first_price;actual_price", "S1;po;PLREGF;PLREGF", "S2;de;PLREGF;")
    sales = put(
        "transactional_sales_1.csv",
        "id;store_code;product_code;sale_date;quantity;value;kind",
        "1;S1;1;2024-01-05;2;20,00;S",
        "2;S1;1;2023-12-31;3;10,00;S",
        "3;S2;1;06.01.2024;1;9,00;R",
        "4;S9;1;2024-01-05;0;9,00;S",
    )
    full = str(tmp_path / "full")
    jobs.import_sales(spark, sales, stores, base, retail, F.col("kind") == "R", full, online=["S2"], keys=["id"])
    out = {r["id"]: r for r in records(read_feed(spark, full))}
    prices = {i: (r["price_promo"], r["price_base"], r["price"]) for i, r in out.items()}
    assert prices == {
        "1": ("5.00", "8.00", "5.00"),
        "2": (None, None, "3.33"),
        "3": (None, "8.00", "8.00"),
        "4": (None, None, None),
    }
    assert (out["3"]["quantity"], out["3"]["value"], out["3"]["sale_date"]) == ("-1.00", "-9.00", "2024-01-06")
    assert {i: r["market_code"] for i, r in out.items()} == {"1": "PL", "2": "PL", "3": "Eshop", "4": "Eshop"}


def test_price_dictionary_names(spark):
    df = spark.createDataFrame([("L", " 1 ", date(2024, 1, 1), None, 2.5)], "external_id string, code string, valid_from date, valid_to date, price double")
    assert tuple(price.known_prices(df).first()) == ("L", "1", date(2024, 1, 1), None, Decimal("2.50"))
