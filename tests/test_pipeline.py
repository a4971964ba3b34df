"""Sources, sinks and the whole build from CSV files."""

from __future__ import annotations

import order_domain
import pytest

from compare import spark_rows
from saldo import pipeline
from saldo.functions.text import clean_value
from saldo.functions.values import parse_date
from saldo.plans import cleaning, quality, star
from saldo.session import get_session, scratch_folder, shared_dir
from saldo.sources.csv_tables import (
    RAW_COLUMNS,
    RAW_FILES,
    malformed_counts,
    malformed_records,
    read_raw_csv,
    read_raw_tables,
    read_typed_csv,
)
from saldo.sources.tables import create_views, read_tables, save_tables, write_csv, write_table, write_tables

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """Raw CSV files made from the order tables, and the build over them."""
    folder, out = tmp_path_factory.mktemp("raw"), tmp_path_factory.mktemp("out")
    tables = order_domain.source_tables(spark, FOLDER)
    for name, file in RAW_FILES.items():
        raw = order_domain.BUILDERS[name](tables).select(*RAW_COLUMNS[name])
        write_csv(raw, f"{folder}/{file}")
    layers = pipeline.build(read_raw_tables(spark, str(folder)), str(out), as_of="2000-01-01")
    pipeline.export_mart(layers, f"{out}/export")
    return layers, str(out), str(folder)


def test_layers_are_complete(built):
    layers, _, _ = built
    assert set(layers["clean"]) == {*cleaning.BUILDERS, *cleaning.STEPS}
    assert set(layers["mart"]) == {*star.BUILDERS, "kpi_base_monthly"}
    assert {r.table_name: r.row_count for r in layers["checks"]["row_counts"].collect()} == {
        name: layers["mart"][name].count()
        for name in ("dim_customer", "dim_plan", "dim_account", "fact_revenue", "fact_subscription", "fact_gl",
                     "fact_sales_marketing", "fact_cash")
    }


def test_csv_build_keeps_the_same_keys_as_the_typed_one(spark, built):
    layers, _, _ = built
    tables = order_domain.source_tables(spark, FOLDER)
    raw = {name: builder(tables) for name, builder in order_domain.BUILDERS.items()}
    for table, columns in {
        "customers": ["customer_id", "signup_date"],
        "subscriptions": ["subscription_id", "start_date", "end_date", "plan_name"],
        "invoices": ["invoice_id", "invoice_date"],
        "gl": ["gl_txn_id", "txn_date"],
        "sales_marketing": ["period", "channel", "campaign_name", "spend", "leads", "won_customers", "cac"],
        "cash": ["period", "entity", "beginning_cash", "ending_cash"],
    }.items():
        expected = cleaning.BUILDERS[table](raw).select(*columns)
        assert spark_rows(layers["clean"][table].select(*columns)) == spark_rows(expected)


def test_views_answer_sql(spark, built):
    months, latest = spark.sql("SELECT count(*), max(period) FROM vw_saas_monthly_kpis").first()
    assert months > 50
    assert spark.sql("SELECT latest_period FROM vw_saas_exec_summary").first()[0] == latest


def test_export_reads_back(spark, built):
    layers, out, _ = built
    for name in ("dim_month", "fact_cash", "fact_revenue"):
        df = layers["mart"][name]
        assert spark_rows(read_typed_csv(spark, f"{out}/export/{name}", df.schema)) == spark_rows(df)


def test_tables_are_replaced(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert write_table(spark.range(3), path).count() == 3
    assert write_table(spark.range(5), path).count() == 5
    write_tables({"a": spark.range(2)}, str(tmp_path))
    assert read_tables(spark, str(tmp_path), ["a", "t"])["a"].count() == 2


def test_catalog_tables_are_replaced(spark):
    for rows in (3, 4):
        save_tables({"numbers": spark.range(rows)}, "saldo_test")
        assert spark.table("saldo_test.numbers").count() == rows
    spark.sql("DROP DATABASE saldo_test CASCADE")


def test_single_file_only_on_request(spark, built, tmp_path):
    layers, _, _ = built
    pipeline.export_mart(layers, str(tmp_path), single_file=["dim_month"])
    assert len(list((tmp_path / "dim_month").glob("part-*.csv"))) == 1
    with pytest.raises(ValueError):
        pipeline.export_mart(layers, str(tmp_path), single_file=["fact_gl"])


def test_catalog_build_can_be_repeated(spark, built):
    layers, _, _ = built
    for _ in range(2):
        found = pipeline.build_catalog(layers, "saldo_catalog_test")
        assert set(found) == {*star.BUILDERS, "vw_saas_monthly_kpis", "vw_saas_exec_summary"}
        rows = spark.sql("SELECT count(*) FROM saldo_catalog_test.fact_gl").first()[0]
        assert rows == layers["mart"]["fact_gl"].count()
    spark.sql("DROP DATABASE saldo_catalog_test CASCADE")


def test_scratch_folder_is_removed(spark):
    with scratch_folder(spark) as folder:
        write_table(spark.range(3), folder)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)


def test_lazy_views(spark):
    create_views({"three": spark.range(3)})
    assert spark.sql("SELECT count(*) FROM three").first()[0] == 3


def test_shared_dir_follows_the_cluster(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert get_session() is not None


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('a,b\n1,"two\nlines, ""quoted"""\n2,\n')
    rows = read_raw_csv(spark, str(path), ["a", "b"]).drop("_seq").collect()
    assert [tuple(r) for r in rows] == [("1", 'two\nlines, "quoted"'), ("2", None)]


def test_malformed_records_are_counted(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('a,b,c\n1,2,3\n1,2,3,4\n5\n"6, and",7,8\n9,10,"open\n')
    good = [tuple(r) for r in read_raw_csv(spark, str(path), ["a", "b", "c"]).drop("_seq").collect()]
    assert good[:3] == [("1", "2", "3"), ("5", None, None), ("6, and", "7", "8")]
    bad = {r.record.strip(): r.fields for r in malformed_records(spark, str(path), ["a", "b", "c"]).collect()}
    assert bad["1,2,3,4"] == 4
    lines = tmp_path / "lines.csv"
    lines.write_text('a,b,c\n1,"broken\nline",3\n4,5,6\n')
    read = read_raw_csv(spark, str(lines), ["a", "b", "c"], multi_line=False).drop("_seq").collect()
    assert [tuple(r) for r in read] == [("4", "5", "6")]
    assert malformed_records(spark, str(lines), ["a", "b", "c"], multi_line=False).count() == 2


def test_malformed_counts_of_a_build(spark, built):
    _, _, folder = built
    assert {r.issues for r in malformed_counts(spark, folder).collect()} == {0}


@pytest.mark.parametrize(
    "text, date",
    [
        ("2024-01-05", "2024-01-05"),
        (" 2024-01-05 10:30:00 ", "2024-01-05"),
        ("2024-01-05T10:30:00.5Z", "2024-01-05"),
        ("20240105", None),
        ("01/05/2024", None),
        ("2024-01-05 xyz", None),
        ("2024-01-05Tfoo", None),
        ("2024-13-05", None),
        ("5 January 2024", None),
    ],
)
def test_dates_are_read_whole(spark, text, date):
    df = spark.createDataFrame([(text,)], "d string")
    found = df.selectExpr(f"CAST({parse_date(df, 'd')} AS STRING)").first()[0]
    assert found == date
    rejected = quality.count_if(f"{clean_value(df, 'd')} IS NOT NULL AND {parse_date(df, 'd')} IS NULL")
    assert df.selectExpr(rejected).first()[0] == (date is None)


# the last test over the build: it replaces the files that the others read
def test_build_can_be_repeated(spark, built):
    layers, out, folder = built
    before = spark_rows(layers["kpis"]["vw_saas_monthly_kpis"])
    again = pipeline.build(read_raw_tables(spark, folder), out, as_of="2000-01-01")
    assert spark_rows(again["kpis"]["vw_saas_monthly_kpis"]) == before
