"""Reading and publishing files."""

import hashlib

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from retailprep.session import clear_scratch, scale_settings, scratch_path, scratch_root, settle, shared_dir
from retailprep.sources import (
    MissingNames,
    column_or_null,
    file_manifest,
    find_column,
    first_column,
    optional,
    publish,
    read_dictionary,
    read_feed,
    read_latest,
    schema_groups,
    write_feed,
    write_manifest,
)
from retailprep.sources.read import latest_path, path_below


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_headers_and_trim(spark, tmp_path):
    path = tmp_path / "wh.csv"
    path.write_bytes("﻿ Store_Code | Qty \n S1 | 2,5 \n|\n".encode())
    df = read_feed(spark, str(path), sep="|", trim=True)
    assert df.columns == ["store_code", "qty"]
    assert rows(df) == [(None, None), ("S1", "2,5")]
    assert rows(read_feed(spark, str(path), sep="|"))[1] == (" S1 ", " 2,5 ")


def test_declared_schema_never_raises(spark, tmp_path):
    path = tmp_path / "calendar.csv"
    path.write_text("opening_date;store_code\n2024-01-02;S1\n2024-13-01;S2\n")
    df = read_feed(spark, str(path), schema="store_code string, opening_date date, closing_date date")
    assert df.dtypes == [("store_code", "string"), ("opening_date", "date"), ("closing_date", "date")]
    assert [(a, str(b), c) for a, b, c in rows(df)] == [("S1", "2024-01-02", None), ("S2", "None", None)]


def test_latest_and_named_file(spark, tmp_path):
    for name, code in (("inventory_2026_03_14", "old"), ("inventory_2026_03_15", "new"), ("zz_2027_01_01", "other")):
        (tmp_path / f"{name}.csv").write_text(f"product_code\n{code}\n")
    (tmp_path / "inventory_2026_03_16.txt").write_text("product_code\nwrong\n")
    assert rows(read_latest(spark, str(tmp_path), "inventory_")) == [("new",)]
    manual = read_latest(spark, str(tmp_path), "inventory_", "MANUAL", "inventory_2026_03_14.csv")
    assert rows(manual) == [("old",)]
    with pytest.raises(ValueError, match="unknown mode"):
        read_latest(spark, str(tmp_path), "inventory_", "NEWEST")
    with pytest.raises(FileNotFoundError):
        read_latest(spark, str(tmp_path), "stock_")


def test_optional_source(spark, tmp_path):
    empty = optional(lambda: read_feed(spark, str(tmp_path / "none.csv")), "a string, b int", spark)
    assert empty.dtypes == [("a", "string"), ("b", "int")]
    assert empty.isEmpty()
    with pytest.raises(ZeroDivisionError):
        optional(lambda: 1 / 0, "a string", spark)


def test_only_absent_sources_are_optional(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    assert optional(lambda: read_dictionary(spark, str(tmp_path / "empty")), "a string", spark).isEmpty()
    spark.range(1).write.parquet(str(tmp_path / "dict"))
    for wrong in ("SELECT missing FROM {d}", "SELECT CAST(id AS DATE) FROM {d}"):
        with pytest.raises(AnalysisException):
            optional(lambda sql=wrong: spark.sql(sql, d=read_dictionary(spark, str(tmp_path / "dict"))), "a string", spark)


def test_folders_are_resolved(spark, tmp_path, monkeypatch):
    inner = tmp_path / "in" / "home" / "in"
    inner.mkdir(parents=True)
    (inner / "inventory_2026_01_01.csv").write_text("product_code\nx\n")
    for folder in (str(inner), f"{inner}/", f"file:{inner}", f"{tmp_path}/in/../in//home/in"):
        assert latest_path(spark, folder, "inventory_").endswith("inventory_2026_01_01.csv")
        assert [r[0] for r in file_manifest(spark, folder).select("file").collect()] == ["inventory_2026_01_01.csv"]
    assert [r[0] for r in file_manifest(spark, str(tmp_path / "in")).select("file").collect()] == ["home/in/inventory_2026_01_01.csv"]
    outside = spark.createDataFrame([("file:/elsewhere/in/x.csv",)], "path string")
    with pytest.raises(Exception, match="not below"):
        outside.select(path_below(spark, str(inner))).collect()
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        latest_path(spark, str(tmp_path / "none"), "inventory_")


def test_dictionary_over_snapshots(spark, tmp_path):
    for day, code in (("2026-01-01", "A"), ("2026-01-02", "B")):
        spark.createDataFrame([(code,)], "code string").write.parquet(str(tmp_path / "dict" / day))
    df = read_dictionary(spark, str(tmp_path / "dict"))
    assert rows(df.select(first_column(df, "product_code", "external_id", "code"))) == [("A",), ("B",)]


def snapshots(spark, folder):
    """Snapshots under four schemas, two of them alike."""
    for day, ddl, rows_of in (
        ("01", "product_code string, external_id string", [("A", "x"), (None, "y")]),
        ("02", "external_id string, value int", [("B", 1)]),
        ("03", "Code bigint", [(7,)]),
        ("04", "external_id string, product_code string", [("z", "D")]),
    ):
        spark.createDataFrame(rows_of, ddl).coalesce(1).write.parquet(f"{folder}/2026-01-{day}/")


def test_dictionary_of_several_schemas(spark, tmp_path):
    snapshots(spark, str(tmp_path / "dict"))
    codes = {"product_code": (("product_code", "external_id", "code"), "string")}
    found = read_dictionary(spark, str(tmp_path / "dict"), codes)
    assert sorted(rows(found), key=str) == sorted([("A",), (None,), ("B",), ("7",), ("D",)], key=str)
    # a scan for each schema, of the mapped columns only
    assert sorted(len(units) for _, units in schema_groups(spark, str(tmp_path / "dict"))) == [1, 1, 2]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3 and "value" not in plan
    # what one schema for all files made of it: a code and a NULL, without a word
    single = read_dictionary(spark, str(tmp_path / "dict"))
    assert "Code" not in single.columns


def test_dictionary_names_that_lack(spark, tmp_path):
    snapshots(spark, str(tmp_path / "dict"))
    columns = {"product_code": (("product_code", "external_id", "code"), "string"), "value": (("value",), "string")}
    with pytest.raises(MissingNames, match="value: none of"):
        read_dictionary(spark, str(tmp_path / "dict"), columns)
    found = read_dictionary(spark, str(tmp_path / "dict"), columns, absent="null")
    assert sorted(rows(found.filter("value IS NOT NULL"))) == [("B", "1")]
    with pytest.raises(ValueError, match="unknown choice"):
        read_dictionary(spark, str(tmp_path / "dict"), columns, absent="skip")
    with pytest.raises(AnalysisException):
        read_dictionary(spark, str(tmp_path / "none"), columns)
    (tmp_path / "empty").mkdir()
    assert optional(lambda: read_dictionary(spark, str(tmp_path / "empty"), columns), "product_code string", spark).isEmpty()


def test_dictionary_files_of_one_folder(spark, tmp_path):
    spark.createDataFrame([("A",)], "product_code string").coalesce(1).write.parquet(str(tmp_path / "dict"))
    spark.createDataFrame([("B",)], "external_id string").coalesce(1).write.mode("append").parquet(str(tmp_path / "dict"))
    codes = {"product_code": (("product_code", "external_id"), "string")}
    assert rows(read_dictionary(spark, str(tmp_path / "dict"), codes, by_file=True)) == [("A",), ("B",)]


def test_columns_by_name(spark):
    df = spark.createDataFrame([("x",)], "StoreDepartment string")
    assert find_column(df, "none", "storedepartment") == "StoreDepartment"
    assert df.select(column_or_null(df, "storedepartment")).dtypes == [("storedepartment", "string")]
    assert df.select(column_or_null(df, "qty", "int")).dtypes == [("qty", "int")]
    with pytest.raises(ValueError, match="none of"):
        first_column(df, "a", "b")


def test_write_keeps_blanks_and_nulls(spark, tmp_path):
    df = spark.createDataFrame([(" a ", None, 1), ("", "x;y", None)], "a string, b string, c int")
    write_feed(df.coalesce(1), str(tmp_path / "out"))
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_text() == 'a;b;c\n a ;;1\n;"x;y";\n'
    write_feed(df.coalesce(1), str(tmp_path / "out"), null_as="?")
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_text() == 'a;b;c\n a ;?;1\n;"x;y";?\n'


def test_write_in_order_over_several_parts(spark, tmp_path):
    df = spark.range(0, 20000, 1, 8).select((F.hash("id") % 1000).alias("k"), "id")
    write_feed(df, str(tmp_path / "out"), order_by=["k", "id"])
    lines = []
    for part in sorted((tmp_path / "out").glob("part-*.csv")):
        lines += [tuple(map(int, line.split(";"))) for line in part.read_text().splitlines()[1:]]
    assert len(lines) == 20000
    assert lines == sorted(lines)


def test_parts_are_bounded(spark, tmp_path):
    write_feed(spark.range(0, 100, 1, 1), str(tmp_path / "out"), part_rows=30)
    parts = list((tmp_path / "out").glob("part-*.csv"))
    assert len(parts) == 4
    assert read_feed(spark, str(tmp_path / "out")).count() == 100


def test_outputs_are_checked_before_the_work(spark):
    broken = spark.range(1).select(F.raise_error(F.lit("worked")).alias("x"))
    for mode, full, sample in (("FULL", None, "s"), ("TEST", "f", None), ("BOTH", "f", None), ("SOME", "f", "s")):
        with pytest.raises(ValueError, match="mode"):
            publish(broken, full, sample, mode)


def test_one_folder_per_list(spark, tmp_path):
    df = spark.range(1000).select(F.concat(F.lit("L"), (F.col("id") % 3).cast("string")).alias("name"), "id")
    write_feed(df, str(tmp_path / "lists"), partition_by="name")
    assert {p.name for p in (tmp_path / "lists").glob("name_key=*")} == {"name_key=L0", "name_key=L1", "name_key=L2"}
    back = read_feed(spark, str(tmp_path / "lists"))
    assert back.filter("name <> name_key").isEmpty()
    assert back.count() == 1000


def test_publish_modes(spark, tmp_path):
    df = spark.range(0, 5000, 1, 4).select(F.col("id").cast("string").alias("id"), (F.col("id") % 2).alias("g"))
    full, sample = str(tmp_path / "full"), str(tmp_path / "sample")
    publish(df, full, sample, "BOTH", sample_order=["id"])
    assert read_feed(spark, full).count() == 5000
    assert rows(read_feed(spark, sample).select("id")) == sorted((str(i),) for i in range(5000))[:1000]
    publish(df, None, sample, "TEST", sample_order=["id"], sample_by="g", sample_n=7, partition_by="g")
    assert rows(read_feed(spark, sample).groupBy("g").count()) == [("0", 7), ("1", 7)]
    with pytest.raises(ValueError, match="overlap"):
        publish(df, str(tmp_path / "a"), str(tmp_path / "a" / "sample"), "BOTH")
    with pytest.raises(ValueError, match="unknown mode"):
        publish(df, full, sample, "SOME")


def test_manifest(spark, tmp_path):
    files = {"a.csv": b"1;2\n", "sub/b.CSV": b"x", "sub/manifest": b"inner"}
    (tmp_path / "sub").mkdir()
    for name, content in {**files, "manifest": b"old", "c.txt": b"no"}.items():
        (tmp_path / name).write_bytes(content)
    manifest = file_manifest(spark, str(tmp_path))
    want = sorted((n, "SHA1", hashlib.sha1(c).hexdigest()) for n, c in files.items())
    assert rows(manifest.drop("bytes")) == want
    assert rows(manifest.select("file", "bytes")) == sorted((n, len(c)) for n, c in files.items())
    assert rows(file_manifest(spark, str(tmp_path), longest=3)) == rows(manifest)
    out = scratch_path(spark, "manifest")
    write_manifest(manifest, out)
    assert [r[0] for r in spark.read.text(out).collect()] == [" ".join(line) for line in want]


def test_settled_frames_are_read_from_the_shared_folder(spark):
    df = spark.range(10).withColumn("r", F.rand())
    settled = settle(df)
    assert rows(settled) == rows(settled)
    assert all(shared_dir(spark).split(":")[-1] in path for path in settled.inputFiles())


def test_scratch_is_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("retailprep.session.shared_dir", lambda spark: str(tmp_path))
    settle(spark.range(3))
    (tmp_path / "retailprep" / "another-application").mkdir()
    assert scratch_root(spark).startswith(str(tmp_path))
    clear_scratch(spark)
    assert [p.name for p in (tmp_path / "retailprep").iterdir()] == ["another-application"]


def test_settings_follow_the_input():
    split = str(128 * 1024**2)
    assert scale_settings(10**9) == {"spark.sql.shuffle.partitions": "200", "spark.sql.files.maxPartitionBytes": split}
    assert scale_settings(100 * 1024**4, 2**29) == {
        "spark.sql.shuffle.partitions": "51400",
        "spark.sql.files.maxPartitionBytes": str(2**29),
    }
