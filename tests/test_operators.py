"""Rewritten operators against their plain forms, and the plans they rely on."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest

import __spark_entry__ as registry
from saldo.functions.values import exact_sum, round2
from saldo.operators.checks import describe, run_checks, run_keyed_checks, run_label_checks, surplus_duplicates
from saldo.operators.dedup import keep_first, keep_last
from saldo.operators.merge import merge_on_period
from saldo.plans import billing, cleaning, kpis, quality

FOLDER = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def subscriptions(spark, rows):
    return spark.createDataFrame(rows, "customer_id string, start_date date, end_date date, subscription_status string")


def random_subscriptions(seed: int, hot_share: float = 0.34):
    rng = random.Random(seed)
    rows = []
    for _ in range(600):
        customer = "hot" if rng.random() < hot_share else f"c{rng.randrange(40)}"
        start = dt.date(2020, 1, 1) + dt.timedelta(days=rng.randrange(1500))
        end = None if rng.random() < 0.1 else start + dt.timedelta(days=rng.randrange(0, 300))
        rows.append((customer, start, end, rng.choice(["Active", "Paused", "Cancelled"])))
    return [*rows, (None, dt.date(2020, 1, 1), None, "Active")]


@pytest.mark.parametrize("seed", [1, 2])
def test_active_customers_match_month_by_month_count(spark, seed):
    rows = random_subscriptions(seed)
    months = [dt.date(2019 + i // 12, i % 12 + 1, 1) for i in range(0, 84, 2)]
    expected = {
        m: len(
            {c for c, s, e, status in rows if c and status != "Cancelled" and s <= m and (e is None or e >= m)}
        )
        for m in months
    }
    asked = spark.createDataFrame([(m,) for m in months], "month_start date")
    actual = {r.period: r.active_customers for r in kpis.active_customers(subscriptions(spark, rows), asked).collect()}
    assert actual == expected


def test_merge_matches_full_outer_joins(spark):
    a = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0), (dt.date(2024, 2, 1), 2.0)], "period date, a double")
    b = spark.createDataFrame([(dt.date(2024, 2, 1), 5), (dt.date(2024, 4, 1), None)], "period date, b int")
    c = spark.createDataFrame([(dt.date(2024, 1, 1), "x")], "period date, c string")
    joined = a.join(b, "period", "full_outer").join(c, "period", "full_outer")
    assert sorted(merge_on_period(a, b, c).collect(), key=str) == sorted(joined.collect(), key=str)


def test_dedup_limits_groups_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("if(id % 3 = 0, 'hot', CAST(id AS STRING)) AS k", "id AS v", "id % 7 AS w")
    for kept, value in ((keep_first(df, "k", ["v"]), 0), (keep_last(df, "k", ["v"]), 999)):
        text = plan_of(kept)
        assert text.index("row_number(), 1, Final") < text.index("Exchange") < text.index("row_number(), 1, Partial")
        assert kept.filter("k = 'hot'").first()["v"] == value and kept.count() == 667


@pytest.mark.parametrize("seq", [[], ["id * 7 % 500 AS _seq"]])
def test_dedup_of_needed_columns(spark, seq):
    some = [f"CAST(pmod(hash(id, {k}), 3) AS INT) AS {c}" for k, c in enumerate("vabc")]
    df = spark.range(500).selectExpr("CAST(id % 40 AS STRING) AS k", *some, *seq)
    whole = keep_last(df, "k", ["v"])
    for needed in (["v"], ["a"], ["b"], ["c", "a"]):
        narrow = keep_last(df, "k", ["v"], needed)
        assert Counter(narrow.select("k", *needed).collect()) == Counter(whole.select("k", *needed).collect())
    assert ("c" in keep_last(df, "k", ["v"], ["b"]).columns) is False


@pytest.mark.parametrize(
    "values, total",
    [
        ([0.1] * 1000 + [1e9 + 0.01, -1e9], 100.01),
        ([0.00004] * 3, 0.00012),
        ([1e15, 1.0], 1e15 + 1),
        ([1e300, 1.0, None], 1e300),
        ([1e-13] * 10, 1e-12),
        ([None], None),
    ],
)
def test_sums_are_exact_in_any_order(spark, values, total):
    rows = [(v,) for v in values]
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        found = spark.createDataFrame(rows, "x double").repartition(4).selectExpr(exact_sum("x")).first()[0]
        assert found == (total if total is None else pytest.approx(total, rel=1e-15))


def test_round2_is_half_even(spark):
    assert [spark.range(1).selectExpr(round2(f"{x}D")).first()[0] for x in (0.125, 0.375, -0.125)] == [0.12, 0.38, -0.12]


def test_check_counters(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z"), (None, "x"), (None, None)], "k string, v string")
    found = run_checks(df, "t", {"dups": surplus_duplicates("k")}).collect()
    found += run_keyed_checks(df, "t", ("k",), "keyed dups", {"nulls": "count_if(v IS NULL)"}).collect()
    found += run_label_checks(df, "t", {"odd": ("v", ["x"])}).collect()
    assert {r.check_name: r.issues for r in found} == {"dups": 3, "keyed dups": 3, "nulls": 1, "odd": 2}
    none = df.limit(0)
    empty = run_keyed_checks(none, "t", ("k",), "dups", {"nulls": "count_if(v IS NULL)"}).collect()
    assert [r.issues for r in empty + run_label_checks(none, "t", {"odd": ("v", ["x"])}).collect()] == [0, 0, 0]


def test_today_is_the_default_day(spark):
    tomorrow = dt.date.today() + dt.timedelta(days=2)
    customers = spark.createDataFrame([("a", tomorrow), ("b", dt.date(2020, 1, 1))], "customer_id string, signup_date date")
    checks = {"customers": quality.date_order()["customers"]}
    assert quality.check_tables({"customers": customers}, checks).first().issues == 1


@pytest.mark.parametrize("customer", ["hot", None])
def test_plan_lookup_splits_a_hot_customer(spark, customer):
    """Half of all subscriptions are one customer's, all without a plan; no task holds a tenth of the rows."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32"}
    settings["spark.sql.adaptive.coalescePartitions.enabled"] = "false"
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        who = "CAST(NULL AS STRING)" if customer is None else f"'{customer}'"
        raw = spark.range(40_000).selectExpr(
            "CAST(id AS STRING) AS subscription_id",
            f"CASE WHEN id % 2 = 0 THEN {who} ELSE concat('c', id % 500) END AS customer_id",
            "DATE'2024-01-01' AS start_date", "CAST(NULL AS DATE) AS end_date",
            "CASE WHEN id % 2 = 1 AND id % 3 > 0 THEN 'Basic' END AS plan_name",
            "1D AS mrr", "12D AS arr", "'active' AS subscription_status", "0D AS discount_pct", "'usd' AS currency",
        )
        names = [(f"c{k}", "Pro") for k in range(500)] + [("hot", "Growth")]
        text = "'x' AS customer_name, 'x' AS industry, 'x' AS region, 'x' AS country, DATE'2024-01-01' AS signup_date"
        rest = "'x' AS acquisition_channel, 'x' AS account_status, plan_name, 'x' AS billing_frequency"
        customers = spark.createDataFrame(names, "customer_id string, plan_name string").selectExpr(
            "customer_id", *text.split(", "), *rest.split(", ")
        )
        clean = cleaning.clean_subscriptions(raw, cleaning.clean_customers(customers))
        found = clean.selectExpr("*", "spark_partition_id() AS task").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(found) == 40_000
    assert max(Counter(r.task for r in found).values()) < 4_000
    plans = Counter((r.customer_id == customer, r.plan_name) for r in found)
    assert plans[True, "Growth" if customer else "Unknown"] == 20_000
    assert {plan for mine, plan in plans if not mine} == {"Basic", "Pro"}


def test_growth_within_a_month_of_several_entities(spark):
    months = [dt.date(2024, m, 1) for m in (1, 2, 3)]
    star = {
        "fact_subscription": spark.createDataFrame(
            [("a", months[0], None, months[0], "Active", 10.0), ("b", months[1], None, months[1], "Active", 15.0)],
            "customer_id string, start_date date, end_date date, period date, subscription_status string, arr double",
        ),
        "fact_revenue": spark.createDataFrame([(months[2], 5.0, False)], "period date, amount double, is_void boolean"),
        "dim_customer": spark.createDataFrame([("a", months[0])], "customer_id string, signup_date date"),
        "fact_gl": spark.createDataFrame([], "period date, account_category string, amount double"),
        "fact_sales_marketing": spark.createDataFrame([], "period date, spend double, leads double, won_customers double"),
        "fact_cash": spark.createDataFrame(
            [(m, e, 1.0) for m in months for e in ("X", "Y")], "period date, entity string, ending_cash double"
        ),
    }
    base = kpis.kpi_base(star)
    assert [r.arr_growth_pct for r in base.collect()] == [None, 0.0, 0.5, 0.0, -1.0, None]
    assert "entity ASC" not in plan_of(base).split("Window", 1)[1].split("Join", 1)[0]


def test_describe_interpolates_quartiles(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,)], "x double")
    row = describe(df, ["x"]).first()
    assert (row["count"], row["mean"], row["p25"], row["p50"], row["p75"], row["max"]) == (4, 4.0, 1.75, 2.5, 4.75, 10.0)


def test_issue_summary_counts_injected_defects(spark):
    finance = registry.Finance(spark, FOLDER)
    tables = {name: finance.clean[name] for name in
              ("customers", "subscriptions", "invoices", "gl", "sales_marketing", "cash", "kpi_base")}
    invoice = tables["invoices"].limit(1)
    broken = invoice.selectExpr(
        *[
            {"total_amount": "total_amount + 1 AS total_amount", "is_void": "NOT is_void AS is_void",
             "due_date": "date_sub(invoice_date, 1) AS due_date"}.get(c, c)
            for c in invoice.columns
        ]
    )

    def counts(tables):
        return {r.check_name: r.issues for r in quality.issue_summary(tables, "2100-01-01").collect()}

    clean = counts(tables)
    assert len(clean) == 32
    assert clean["duplicate_invoice_id"] == clean["bad_invoice_math"] == clean["critical_nulls_total"] == 0
    dirty = counts({**tables, "invoices": tables["invoices"].unionByName(broken)})
    changed = {k: dirty[k] - clean[k] for k in clean if dirty[k] != clean[k]}
    assert changed == {"duplicate_invoice_id": 1, "bad_invoice_math": 1, "void_flag_mismatch": 1, "bad_invoice_dates": 1}


def test_two_kpi_tables_agree_where_they_should(spark):
    finance = registry.Finance(spark, FOLDER)
    view = {r.period: r for r in finance_kpis(finance).collect()}
    base = finance.clean["kpi_base"].collect()
    for row in base:
        month = view[row.period]
        for column in ("revenue", "new_arr_booked", "active_customers", "churned_customers", "gross_margin", "ltv"):
            assert row[column] == month[column], (row.period, column)
        assert row.COGS == month.cogs and row["R&D"] == month.rnd
        assert row.cac == (0 if month.cac is None else pytest.approx(month.cac, abs=0.00501))
    cash = {}
    for row in base:
        cash[row.period] = cash.get(row.period, 0) + row.ending_cash
    assert all(cash[p] == pytest.approx(view[p].ending_cash) for p in cash)


def finance_kpis(finance):
    return kpis.monthly_kpis(finance.kpi_star)


def test_billing_schedule(spark):
    rows = [
        ("mid", "c", dt.date(2024, 1, 15), dt.date(2024, 3, 1), 100.0, 10.0),
        ("first", "c", dt.date(2024, 11, 1), None, 33.33, None),
        ("short", "c", dt.date(2024, 1, 5), dt.date(2024, 1, 20), 5.0, 0.0),
        ("backwards", "c", dt.date(2024, 5, 9), dt.date(2024, 5, 1), None, 0.0),
        ("undated", "c", None, None, 5.0, 0.0),
    ]
    schema = (
        "subscription_id string, customer_id string, start_date date, end_date date, mrr double, discount_pct double"
    )
    invoices = billing.billing_schedule(spark.createDataFrame(rows, schema), "2024-12-31").collect()
    assert sorted((r.invoice_id, r.amount, r.tax, r.total_amount) for r in invoices) == [
        ("backwards-202405", 0.0, 0.0, 0.0),
        ("first-202411", 33.33, 1.67, 35.0),
        ("first-202412", 33.33, 1.67, 35.0),
        ("mid-202402", 90.0, 4.5, 94.5),
        ("mid-202403", 90.0, 4.5, 94.5),
    ]
    assert {r.due_date - r.invoice_date for r in invoices} == {dt.timedelta(days=30)}


@pytest.mark.parametrize("name", ["monthly_kpis", "kpi_base", "active_customers", "dq_summary", "dim_date"])
def test_plans_hold_no_nested_loops_and_no_python(spark, name):
    text = plan_of(registry.queries()[name](spark, FOLDER))
    for operator in ("BroadcastNestedLoopJoin", "CartesianProduct", "ArrowEvalPython", "BatchEvalPython", "MapInPandas"):
        assert operator not in text
