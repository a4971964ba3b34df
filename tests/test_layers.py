"""Written layers: watched counters, bucketed and published versions, month states, date bitmaps, checksums."""

from __future__ import annotations

import datetime as dt
import threading
import time

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
import order_domain
from compare import spark_rows
from saldo import pipeline
from saldo.operators import quantiles
from saldo.operators.checks import checksum_rows
from saldo.plans import cleaning, kpis, months, quality, star
from saldo.session import shuffles_dropped
from saldo.sources.csv_tables import RAW_COLUMNS
from saldo.sources.tables import dealt_out, publish, save_tables, write_table, write_version

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """The clean tables and the star schema, written."""
    out, finance = str(tmp_path_factory.mktemp("layers")), registry.Finance(spark, FOLDER)
    clean, counters = pipeline.clean_layer(finance.raw, lambda df, name: write_table(df, f"{out}/{name}"), "2000-01-01")
    mart = pipeline.mart_layer(clean, lambda df, name: write_table(df, f"{out}/mart_{name}"))
    return clean, mart, counters


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_watched_counters_equal_separate_checks(spark, written, tmp_path):
    """Also with defects in the table: rows twice, wrong totals, flags, dates, labels and missing keys."""
    clean, _, _ = written
    invoices = clean["invoices"]
    broken = invoices.limit(7).selectExpr(
        *[{"total_amount": "total_amount + 1 AS total_amount", "is_void": "NOT is_void AS is_void",
           "due_date": "date_sub(invoice_date, 1) AS due_date", "customer_id": "NULL AS customer_id",
           "invoice_status": "concat('odd ', length(invoice_id) % 2) AS invoice_status"}.get(c, c)
          for c in invoices.columns]
    )
    for k, table in enumerate((invoices, invoices.unionByName(broken), invoices.limit(0))):
        watched = quality.Watched(table, "invoices", "2000-01-01")
        stored = write_table(watched.table, str(tmp_path / f"t{k}"))
        assert stored.columns == invoices.columns
        groups = [{"invoices": g["invoices"]} for g in
                  (quality.CRITICAL_NULLS, quality.date_order("2000-01-01"), quality.INVOICE_MATH)]
        separate = quality.check_tables({"invoices": table}, *groups).collect()
        check, keys = quality.DUPLICATES["invoices"]
        expected = {r.check_name: r.issues for r in separate}
        expected[check] = table.count() - table.select(*keys).distinct().count()
        allowed = quality.ALLOWED_VALUES["invoices"]["unexpected_invoice_statuses"][1]
        odd = table.filter(~F.col("invoice_status").isin(allowed)).select("invoice_status").distinct().count()
        expected["unexpected_invoice_statuses"] = odd
        assert {r.check_name: r.issues for r in watched.counters(stored).collect()} == expected


def test_the_build_counts_what_separate_checks_count(written):
    clean, mart, counters = written
    base = kpis.kpi_base(mart)
    summary = quality.summarised(counters.unionByName(quality.base_checks(base)))
    separate = quality.issue_summary(quality.checked_tables({**clean, "kpi_base": base}), "2000-01-01")
    assert spark_rows(summary) == spark_rows(separate.select(summary.columns))


def test_bucketed_tables_need_no_exchange_on_their_key(spark, written):
    clean, mart, _ = written
    try:
        found = pipeline.build_catalog({"mart": mart}, "saldo_buckets")
        for table, keys in star.KEYS.items():
            assert spark.table(f"saldo_buckets.{table}").count() == mart[table].count()
            assert "Exchange" not in plan_of(found[table].groupBy(*keys).count())
        joined = found["fact_subscription"].hint("merge").join(found["dim_customer"], "customer_id")
        # only the side that is bucketed by another key moves
        assert plan_of(joined).count("Exchange hashpartitioning") == 1
        assert spark_rows(found["vw_saas_monthly_kpis"]) == spark_rows(kpis.monthly_kpis(mart))
    finally:
        spark.sql("DROP DATABASE IF EXISTS saldo_buckets CASCADE")


def test_clean_layer_in_buckets(spark, written):
    clean, _, _ = written
    try:
        for name, keys in pipeline.CLEAN_KEYS.items():
            source = clean["valid_subscriptions" if name == "subscriptions" else name]
            table = spark.table(write_version(source, "saldo_clean_buckets", name, "1", keys, 4))
            assert table.rdd.getNumPartitions() == 4
            assert "Exchange" not in plan_of(table.groupBy(*keys).count())
    finally:
        spark.sql("DROP DATABASE IF EXISTS saldo_clean_buckets CASCADE")


def test_a_reader_sees_the_old_or_the_new_tables(spark):
    database = "saldo_publish"
    numbers = f"{database}.numbers"
    try:
        save_tables({"numbers": spark.range(3), "letters": spark.range(1)}, database)
        before = spark.table(numbers)
        # a build that has written but not published, and one that fails in between
        half = write_version(spark.range(4), database, "numbers", "half")
        assert spark.table(numbers).count() == before.count() == 3
        with pytest.raises(Exception, match="boom"):
            save_tables({"numbers": spark.range(9), "letters": spark.range(1).selectExpr("raise_error('boom') AS id")}, database)
        assert spark.table(numbers).count() == 3
        publish({"numbers": half}, database)
        # who has begun to read goes on with the former table
        assert before.count() == 3 and spark.table(numbers).count() == 4
        save_tables({"numbers": spark.range(5)}, database)
        assert spark.table(numbers).count() == 5 and spark.table(f"{database}.letters").count() == 1
        versions = [r.tableName for r in spark.sql(f"SHOW TABLES IN {database} LIKE 'numbers__v*'").collect()]
        assert len(versions) == 2
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_a_former_table_becomes_a_view(spark):
    try:
        spark.sql("CREATE DATABASE saldo_former")
        spark.range(2).write.saveAsTable("saldo_former.numbers")
        assert save_tables({"numbers": spark.range(6)}, "saldo_former")["numbers"].count() == 6
    finally:
        spark.sql("DROP DATABASE IF EXISTS saldo_former CASCADE")


def test_states_hold_the_monthly_components(written):
    _, mart, _ = written
    states = months.month_states(mart).cache()
    by_part = {
        "bookings": kpis.monthly_bookings(mart["fact_subscription"]).selectExpr("period", "new_customers AS n"),
        "churned": kpis.churned_customers(mart["fact_subscription"]).selectExpr("period", "churned_customers AS n"),
        "signups": kpis.monthly_signups(mart["dim_customer"]).selectExpr("period", "customer_signups AS n"),
    }
    for part, expected in by_part.items():
        assert spark_rows(states.filter(f"part = '{part}'").selectExpr("period", "number AS n")) == spark_rows(expected)
    total = "CAST(amount AS DOUBLE) + rest AS total"
    revenue = states.filter("part = 'revenue'").selectExpr("period", total)
    assert spark_rows(revenue) == spark_rows(kpis.monthly_revenue(mart["fact_revenue"]).selectExpr("period", "revenue AS total"))
    cash = kpis.aggregate(states.filter("part = 'cash'"), ["period"], {"total": "CAST(sum(amount) AS DOUBLE) + sum(rest)"})
    assert spark_rows(cash) == spark_rows(kpis.monthly_cash(mart["fact_cash"]).selectExpr("period", "ending_cash AS total"))


def test_months_can_be_replaced(written):
    """New facts of one month: its states alone are computed anew."""
    _, mart, _ = written
    month = mart["fact_revenue"].agg(F.min("period")).first()[0]
    late = mart["fact_revenue"].filter(F.col("period") == month).limit(3).withColumn("amount", F.lit(7.25))
    changed = {**mart, "fact_revenue": mart["fact_revenue"].unionByName(late)}
    anew = months.month_states({"fact_revenue": changed["fact_revenue"].filter(F.col("period") == month)}, ["fact_revenue"])
    replaced = months.replaced_months(months.month_states(mart), anew)
    assert spark_rows(kpis.monthly_kpis_of(replaced)) == spark_rows(kpis.monthly_kpis(changed))
    assert spark_rows(kpis.monthly_kpis_of(replaced)) != spark_rows(kpis.monthly_kpis(mart))


def test_each_fact_is_read_once(written):
    _, mart, _ = written
    text = plan_of(kpis.exec_summary(kpis.monthly_kpis(mart)))
    assert text.count("FileScan") == len(months.VIEW_FACTS)


def test_bitmaps_hold_every_day(spark):
    days = [dt.date(*d) for d in [(1, 1, 1), (1880, 4, 1), (1880, 4, 16), (1969, 12, 31), (1970, 1, 1), (1970, 1, 2),
                                  (2059, 9, 18), (2059, 9, 19), (9999, 12, 31)]]
    days += [dt.date(2020, 1, 1) + dt.timedelta(days=3 * k) for k in range(500)]
    rows = spark.createDataFrame([(d,) for d in [*days, *days, None]], "date_key date").repartition(5)
    assert sorted(r[0] for r in star.days_of_bitmaps(star.date_bitmaps(rows)).collect()) == sorted(days)
    assert star.days_of_bitmaps(star.date_bitmaps(rows.limit(0))).count() == 0
    # bitmaps of two tables merge
    halves = [star.date_bitmaps(rows.filter(F.dayofmonth("date_key") % 2 == k)) for k in (0, 1)]
    merged = halves[0].unionByName(halves[1]).groupBy("bucket").agg(F.bitmap_or_agg("days").alias("days"))
    assert star.days_of_bitmaps(merged).count() == len(days)


def test_no_task_sorts_its_rows_for_the_bitmaps(spark):
    """What reads the rows, below the first shuffle, hands on distinct days from a hash table."""
    text = plan_of(star.date_bitmaps(spark.range(10).selectExpr("date_from_unix_date(CAST(id AS INT)) AS date_key")))
    over_rows = text[text.rindex("Exchange") :]
    assert "HashAggregate" in over_rows and "Sort" not in over_rows


def test_tasks_over_rows_sort_no_dates_for_the_bitmaps(spark):
    """In the whole plan of a query over the date dimension, days are distinct and shuffled before the bitmaps."""
    lines = plan_of(registry.queries()["dim_month"](spark, FOLDER)).splitlines()
    built = [k for k, line in enumerate(lines) if "partial_bitmap_construct_agg" in line]
    assert built and all("Exchange" in "".join(lines[k + 1 : k + 5]) for k in built)


def dates_of(df, columns):
    return spark_rows(df.select(*columns))


@pytest.mark.parametrize("table", ["invoices", "gl", "customers", "valid_subscriptions"])
def test_dates_without_the_rows(spark, written, table):
    columns = star.DATE_COLUMNS[table]
    found = registry.Finance(spark, FOLDER).dates[table]
    assert dates_of(found, columns) == dates_of(written[0][table], columns)
    assert "Window" not in plan_of(found) or table == "invoices"


def test_dates_of_tied_open_and_early_rows(spark):
    day = dt.date
    rows = [
        ("a", day(2020, 1, 1), day(2020, 5, 1)),
        ("a", day(2020, 1, 1), None),
        ("b", day(1931, 2, 3), day(1969, 12, 31)),
        ("b", day(1931, 2, 3), day(1931, 2, 3)),
        ("b", day(1930, 2, 3), None),
        (None, day(2020, 1, 1), day(9999, 12, 31)),
        ("late", day(2020, 1, 1), day(2019, 1, 1)),
        ("a ", day(2020, 1, 1), None),
    ]
    raw = spark.createDataFrame(rows, "subscription_id string, start_date date, end_date date").selectExpr(
        "subscription_id", "'c' AS customer_id", "start_date", "end_date", "'Pro' AS plan_name", "1D AS mrr", "12D AS arr",
        "'Active' AS subscription_status", "0D AS discount_pct", "'USD' AS currency",
    )
    columns = ["start_date", "end_date"]
    for given in (raw, raw.limit(0)):
        kept = cleaning.valid_subscriptions(given)
        assert dates_of(cleaning.subscription_dates(given), columns) == dates_of(kept, columns)


def test_row_counts_read_footers_alone(written):
    _, mart, _ = written
    text = plan_of(star.mart_row_counts(mart))
    assert text.count("ReadSchema: struct<>") == len(star.COUNTED_TABLES)


def test_row_counts_before_the_dedup(spark, written):
    _, mart, _ = written
    finance = registry.Finance(spark, FOLDER)
    assert spark_rows(star.kept_row_counts(finance.raw, finance.clean)) == spark_rows(star.mart_row_counts(mart))


def test_checksums_see_every_change(spark):
    df = spark.createDataFrame([("a", 1.5, None), ("b", 2.25, True), (None, -0.0, False)], "`x'y` string, d double, b boolean")
    found = {r.column_name: tuple(r)[2:] for r in checksum_rows(df, "t").collect()}
    assert {c: n for c, (n, _) in found.items()} == {"x'y": 2, "d": 3, "b": 2}
    assert {r.column_name: tuple(r)[2:] for r in checksum_rows(df.repartition(3), "t").collect()} == found
    other = df.withColumn("d", F.col("d") + F.when(F.col("b"), 0.01).otherwise(0))
    changed = {r.column_name: tuple(r)[2:] for r in checksum_rows(other, "t").collect()}
    assert [c for c in found if found[c] != changed[c]] == ["d"]
    assert checksum_rows(df.limit(0), "t").first().checksum == "0"


def test_small_scans_are_dealt_out(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).coalesce(1).write.parquet(path)
    assert dealt_out(spark.read.parquet(path), "id").rdd.getNumPartitions() == 8
    spark.range(1000).repartition(20).write.mode("overwrite").parquet(path)
    assert "Exchange" not in plan_of(dealt_out(spark.read.parquet(path), "id"))


def test_dealt_tasks_grow_with_the_rows(spark, tmp_path):
    """Few files or many, a task gets no more rows than it may hold, however large the table is."""
    path = str(tmp_path / "t")
    for files in (1, 20):
        spark.range(10_000).repartition(files).write.mode("overwrite").parquet(path)
        dealt = dealt_out(spark.read.parquet(path), "id", rows=100)
        assert dealt.rdd.getNumPartitions() == 100
        assert dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 200
        assert dealt.distinct().count() == 10_000


def test_orders_in_one_row_group_are_not_one_tasks(spark, tmp_path, monkeypatch):
    """Each order is a row that the scan would sort or aggregate, so many are dealt out; few stay as they are."""
    path = str(tmp_path / "orders")
    columns = ["id AS o_orderkey", "id % 7 AS o_custkey", "'F' AS o_orderstatus", "id + 0.5D AS o_totalprice",
               "CAST(date_add(DATE '2024-01-01', CAST(id % 400 AS INT)) AS TIMESTAMP_NTZ) AS o_orderdate",
               "'1-URGENT' AS o_orderpriority"]
    rows = spark.range(10_000).selectExpr(*columns)
    rows = rows.union(rows.limit(3000).selectExpr("CAST(NULL AS BIGINT)", *rows.columns[1:]))
    rows.union(rows.filter("o_orderkey < 50")).coalesce(1).write.parquet(path)
    orders = {"orders": spark.read.schema(order_domain.SCHEMAS["orders"]).parquet(path)}
    whole = order_domain.raw_subscriptions(orders)
    assert "Exchange" not in plan_of(whole)
    monkeypatch.setattr(order_domain, "ORDERS_A_TASK", 500, raising=False)
    dealt = order_domain.raw_subscriptions(orders)
    assert dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] < 1000
    assert spark_rows(dealt) == spark_rows(whole)
    assert spark_rows(cleaning.subscription_dates(dealt)) == spark_rows(cleaning.subscription_dates(whole))


def test_ledger_amounts_are_those_of_the_clean_ledger(spark):
    """Rows that differ in late columns only, or in a deciding one, give the same kept values with fewer columns sorted."""
    columns = RAW_COLUMNS["gl"]
    rows = [
        ("a", "2024-01-01", "1", "Cash", "x", "c", "v", "5", "DR", "e", "m1"),
        ("a", "2024-01-01", "1", "Cash", "x", "c", "v", "5", "CR", "f", "m2"),
        ("b", "2024-01-01", None, "R&D", None, "c", "v", "7", None, "e", None),
        ("b", "2024-01-01", None, "R&D", "y", "c", "v", "6", None, "e", "m"),
        ("b", "2023-01-01", "9", "S&M", "z", "c", "v", "8", None, "e", "m"),
        (None, "2024-01-01", "1", "Cash", "x", "c", "v", "5", "DR", "e", "m1"),
    ]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    narrow = cleaning.ledger_amounts(raw)
    assert spark_rows(narrow) == spark_rows(cleaning.clean_gl(raw).select(*narrow.columns))
    assert "memo" not in plan_of(narrow).split("Scan ")[0]


def test_subscription_intervals_are_those_of_valid_subscriptions(spark):
    """Rows that differ in late columns only, or in a deciding one, give the same kept values with fewer columns sorted."""
    columns = RAW_COLUMNS["subscriptions"]
    rows = [
        ("a", "c1", "2024-01-01", "2024-05-01", "Pro", "5", "60", "active", "0", "USD"),
        ("a", "c1", "2024-01-01", None, "Pro", "5", "60", "active", "0", "USD"),
        ("a", "c1", "2024-01-01", None, "Pro", "5", "60", "active", "5", "cad"),
        ("b", " c2 ", "2024-02-01", None, None, "7", None, "paused ", None, None),
        ("b", " c2 ", "2024-02-01", None, "Basic", "6", None, "CANCELLED", None, "usd"),
        ("c", None, "2024-02-01", "2024-03-01", "Basic", "6", None, None, None, "usd"),
        ("c", "c3", "2024-02-01", "2024-03-01", "Basic", "6", None, "active", None, "usd"),
        ("d", "c4", "2024-02-01", "2024-01-01", "Basic", "6", None, "active", None, "usd"),
        ("e", "c4", "2024-02-01", None, "Basic", "-6", None, "active", None, "usd"),
        (None, "c5", "2024-02-01", None, "Basic", "6", None, "active", None, "usd"),
        (None, "c5", "2024-02-01", None, "Basic", "9", None, "cancelled", None, "usd"),
    ]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))
    narrow = cleaning.subscription_intervals(raw)
    assert spark_rows(narrow) == spark_rows(cleaning.valid_subscriptions(raw).select(*narrow.columns))


def test_active_customers_sort_deciding_columns_only(spark):
    text = plan_of(registry.queries()["active_customers"](spark, FOLDER))
    assert "subscription_status" in text and "discount_pct" not in text and "currency" not in text


def test_mart_queries_write_each_clean_table_once(spark, monkeypatch):
    """Exports, catalog and NULL checks read written clean tables: each is deduplicated once a query."""
    calls = []
    for name in ("clean_invoices", "clean_gl", "ledger_amounts"):
        plan = getattr(cleaning, name)
        monkeypatch.setattr(cleaning, name, lambda raw, name=name, plan=plan: calls.append(name) or plan(raw))
    stored = []
    monkeypatch.setattr(registry, "write_table", lambda df, path, **o: stored.append(path) or write_table(df, path, **o))
    for query in ("mart_export", "mart_checksums", "catalog_build", "dq_nulls"):
        calls.clear(), stored.clear()
        assert registry.queries()[query](spark, FOLDER).count() > 0
        assert sorted(calls) == ["clean_gl", "clean_invoices"] if query != "dq_nulls" else ["clean_invoices", "ledger_amounts"]
        names = [path.rsplit("/", 1)[1] for path in stored]
        assert sorted(names) == ["cash", "customers", "gl", "invoices", "sales_marketing", "valid_subscriptions"]


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    names = manager.getAllFiles().mkString("\n").splitlines()
    return {name.rsplit("/", 1)[-1] for name in names if "/shuffle_" in name}


def shuffles_left(spark, before):
    """Shuffle files that have come since; they are removed in the background, so a few seconds are allowed."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    return left


@pytest.mark.parametrize("query", ["mart_checksums", "mart_export", "catalog_build"])
def test_mart_queries_hold_no_shuffles_of_what_is_written(spark, monkeypatch, query):
    """Neither while later tables are written, nor at the end; the session is left as it was."""
    before, left = shuffle_files(spark), {}

    def written(df, path, **options):
        table, name = write_table(df, path, **options), path.rsplit("/", 1)[1]
        if name in ("gl", "invoices"):
            left[name] = shuffles_left(spark, before)
        return table

    monkeypatch.setattr(registry, "write_table", written)
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert len(registry.queries()[query](spark, FOLDER).collect()) > 0
    assert left == {"gl": set(), "invoices": set()}
    assert not shuffles_left(spark, before)
    assert spark.conf.get(setting) == "false"


def test_shuffles_are_dropped_within_the_block_only(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = shuffle_files(spark)
    with pytest.raises(ValueError), shuffles_dropped(spark):
        twice = spark.range(100).repartition(3, "id").groupBy("id").count()
        # a statement that runs again makes its shuffles again
        assert len(twice.collect()) == 100 and not shuffles_left(spark, before) and len(twice.collect()) == 100
        raise ValueError
    assert spark.conf.get(setting) == "false"
    kept = spark.range(100).repartition(3, "id")
    assert len(kept.collect()) == 100 and shuffle_files(spark) - before


def test_large_clean_tables_are_written_alone(spark):
    """Their shuffles are the most of the disk; the other tables are written side by side."""
    lock, writing, beside = threading.Lock(), set(), {}

    def write(df, name):
        with lock:
            writing.add(name)
            for one in writing:
                beside[one] = beside.get(one, set()) | writing - {one}
        time.sleep(0.3)
        with lock:
            beside[name] |= writing - {name}
            writing.remove(name)
        return df

    pipeline.written_layer(registry.Finance(spark, FOLDER).raw, write)
    assert set(beside) == {"customers", "valid_subscriptions", "invoices", "gl", "sales_marketing", "cash"}
    assert beside["gl"] == beside["invoices"] == set() != beside["customers"]


@pytest.mark.parametrize("held, accuracy", [(1 << 20, 10_000), (50, 100), (5, 20)])
def test_quantiles_are_exact(spark, held, accuracy):
    """Brackets narrowed several times give what ``percentile`` gives, which holds all distinct values."""
    rows = spark.range(4_000).selectExpr(
        "stack(5, 'spread', CAST(pmod(xxhash64(id), 100003) AS DOUBLE), 'ties', CAST(id % 3 AS DOUBLE), "
        "'one', CASE WHEN id = 7 THEN 2.5D END, 'none', CAST(NULL AS DOUBLE), "
        "'heavy', CASE WHEN id % 3 = 0 THEN CAST(id AS DOUBLE) ELSE 1000D END) AS (metric, value)"
    )
    shares = [0.0, 0.25, 0.5, 0.731, 1.0]
    found = {(r.metric, r.share): r.quantile for r in quantiles.exact_quantiles(rows, shares, held, accuracy).collect()}
    exact = rows.groupBy("metric").agg(*[F.expr(f"percentile(value, {s}D) AS p{k}") for k, s in enumerate(shares)]).collect()
    expected = {(r.metric, s): r[f"p{k}"] for r in exact for k, s in enumerate(shares) if r[f"p{k}"] is not None}
    assert found == pytest.approx(expected)
    assert quantiles.exact_quantiles(rows.limit(0), shares).count() == 0
