from __future__ import annotations

from collections import Counter
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallymart.contract import ORDER_FILE_COLUMNS, gold_schema
from tallymart.operators.profile import schema_drift
from tallymart.operators.quality import classify, quality_metrics
from tallymart.sources import readers, writers
from tallymart.sources.paths import LakePaths, new_run_id

HEADER = "Category,Product Name,Sales,Order Date\n"
QUOTED = 'OS,"Ring, 3"" Cap, Black",1.5,2/5/2011\n'


def put(folder, name, text, encoding="utf-8"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode(encoding))
    return str(folder)


def test_doubled_quotes_stay_in_their_field(spark, tmp_path):
    df = readers.read_bronze(spark, put(tmp_path / "raw", "a.csv", HEADER + QUOTED))
    row = df.first()
    assert (row["Product Name"], row["Sales"]) == ('Ring, 3" Cap, Black', "1.5")
    assert row[readers.CORRUPT] is None
    assert all(f.dataType.typeName() == "string" for f in df.schema)


def test_short_and_long_rows_are_marked(spark, tmp_path):
    text = HEADER + QUOTED + "OS,Pen,2\n" + "OS,Pen,2,2/5/2011,extra\n"
    df = readers.read_bronze(spark, put(tmp_path / "raw", "a.csv", text))
    assert sum(r[readers.CORRUPT] is not None for r in df.collect()) == 2
    named = df.toDF("category", "product", "sales_clean", "order_date", readers.CORRUPT)
    typed = named.withColumn("sales_clean", F.expr("try_cast(sales_clean as decimal(18,4))"))
    # a count that needs few columns sees the same rejects as a full read
    row = quality_metrics(classify(typed), F.size("reject_reasons") == 0).first()
    assert (row["row_in"], row["row_bad"]) == (3, 2)


def test_latin1(spark, tmp_path):
    path = put(tmp_path / "raw", "a.csv", "Sales,Stadt\n1,Zürich\n", "latin-1")
    assert readers.read_bronze(spark, path, encoding="ISO-8859-1").first()["Stadt"] == "Zürich"


def test_line_breaks_inside_quotes(spark, tmp_path):
    path = put(tmp_path / "raw", "a.csv", 'Sales,Note\n1,"two\nlines"\n')
    df = readers.read_bronze(spark, path, multiline=True)
    assert df.count() == 1 and df.first()["Note"] == "two\nlines"


def test_a_file_with_other_columns_fails_the_read(spark, tmp_path):
    put(tmp_path / "raw", "a.csv", "Sales,Order Date\n1,2/5/2011\n")
    path = put(tmp_path / "raw", "b.csv", "Order Date,Sales\n2/5/2011,1\n")
    with pytest.raises(Exception, match="(?i)header|CSV"):
        readers.read_bronze(spark, path).collect()


def test_csv_folder_reads_nested_parts_and_sorts_by_number(spark, tmp_path):
    put(tmp_path / "gold" / "one", "p1.csv", "year,month,total_sales\n2011,10,5.0\n")
    put(tmp_path / "gold" / "two", "p2.csv", "year,month,total_sales\n2011,9,7.5\n")
    put(tmp_path / "gold", "notes.txt", "not a part\n")
    df = readers.read_csv_folder(spark, str(tmp_path / "gold"), gold_schema())
    assert [r["month"] for r in df.orderBy("year", "month").collect()] == [9, 10]
    assert df.agg(F.sum("total_sales")).first()[0] == Decimal("12.5")


def test_csv_folder_without_parts_is_an_error(spark, tmp_path):
    put(tmp_path / "gold", "notes.txt", "not a part")
    with pytest.raises(FileNotFoundError):
        readers.read_csv_folder(spark, str(tmp_path / "gold"), gold_schema())


def test_optional_table(spark, tmp_path):
    assert readers.read_optional(spark, str(tmp_path / "none")) is None
    path = str(tmp_path / "some")
    spark.range(3).write.parquet(path)
    assert readers.read_optional(spark, path).count() == 3


def test_silver_layout_prunes_months(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = [(date(2011, m, 1), Decimal(m), 2011, m) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "order_date date, sales_clean decimal(18,4), year int, month int")
    writers.write_silver(df, path)
    assert (tmp_path / "silver" / "year=2011" / "month=12").is_dir()
    part = readers.read_silver(spark, path, ["month", "sales_clean"], (2011, 3), (2011, 5))
    assert sorted(r["month"] for r in part.collect()) == [3, 4, 5]
    scan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in scan or "PartitionFilters: [((" in scan
    assert "order_date" not in scan


def test_silver_as_csv_keeps_blanks_and_arrays(spark, tmp_path):
    path = str(tmp_path / "flat")
    df = spark.createDataFrame([(" a ", ["x", "y"])], "name string, tags array<string>")
    writers.write_silver_csv(df, path)
    row = readers.read_csv_folder(spark, path).first()
    assert row["name"] == " a " and row["tags"] == "[x, y]"


def test_export_is_one_sorted_file(spark, tmp_path):
    path = tmp_path / "export"
    writers.export_csv(spark.createDataFrame([(2, 1), (1, 12), (1, 2)], "year int, month int"), str(path), "year", "month")
    (part,) = path.glob("*.csv")
    assert part.read_text().split() == ["year,month", "1,2", "1,12", "2,1"]


def test_drift_of_an_order_file(spark, tmp_path):
    df = readers.read_bronze(spark, put(tmp_path / "raw", "a.csv", "sales,order_date,coupon\n1,2/5/2011,x\n"))
    drift = schema_drift(spark, readers.text_schema(list(ORDER_FILE_COLUMNS)), df.schema)
    counts = Counter(r["status"] for r in drift.collect())
    assert counts == {"same": 3, "added": 1, "missing": len(ORDER_FILE_COLUMNS) - 2}


def test_paths_and_run_ids():
    paths = LakePaths("s3a://lake/retail/")
    assert paths.silver == "s3a://lake/retail/silver/orders"
    assert paths.gold("m") == "s3a://lake/retail/gold/m"
    assert new_run_id()[15] == "Z" and new_run_id() != new_run_id()


def test_a_folder_goes_before_the_folders_below_it(spark, tmp_path):
    (tmp_path / "old").mkdir()
    (tmp_path / "old" / "part-0.csv").write_text("a\n1\n")
    assert [r.a for r in readers.read_csv_folder(spark, str(tmp_path)).collect()] == ["1"]
    (tmp_path / "part-1.csv").write_text("a\n2\n")
    assert [r.a for r in readers.read_csv_folder(spark, str(tmp_path)).collect()] == ["2"]


def test_blank_and_repeated_headers(spark, tmp_path):
    (tmp_path / "f.csv").write_text("Sales,sales,,Sales,Note\n1,2,3,4,n\n5,6\n")
    df = readers.read_bronze(spark, str(tmp_path))
    assert df.columns == ["Sales", "sales_2", "column_3", "Sales_3", "Note", "corrupt_record"]
    assert [tuple(r)[:5] for r in df.where("corrupt_record is null").collect()] == [("1", "2", "3", "4", "n")]
    assert df.count() == 2
