"""Cleaners on small hand-made tables, as text and in file order."""

from __future__ import annotations

import csv
import datetime as dt

import pytest

from saldo.plans import cleaning
from saldo.sources.csv_tables import RAW_COLUMNS, read_raw_csv


@pytest.fixture
def raw(spark, tmp_path):
    """Write rows (dicts) of a raw table to CSV and scan it."""

    def write(table, *rows, **options):
        path = tmp_path / f"{table}.csv"
        with path.open("w", newline="") as f:
            writer = csv.DictWriter(f, RAW_COLUMNS[table])
            writer.writeheader()
            writer.writerows(rows)
        return read_raw_csv(spark, str(path), RAW_COLUMNS[table], **options)

    return write


def by(df, key):
    return {row[key]: row.asDict() for row in df.collect()}


def test_customers(raw):
    rows = by(
        cleaning.clean_customers(
            raw(
                "customers",
                {"customer_id": "C1 ", "customer_name": "johnson-owens, inc", "region": "NA", "signup_date": ""},
                {"customer_id": "C1", "customer_name": "second", "region": "emea", "signup_date": "2024-02-01"},
                {"customer_id": "C1", "customer_name": "third", "region": "apac", "signup_date": "2024-02-01"},
                {"customer_id": "C2", "country": "USA", "account_status": " paused ", "plan_name": "enterprise "},
                {"customer_id": "C3", "signup_date": "01/02/2024", "billing_frequency": "ANNUAL"},
            )
        ),
        "customer_id",
    )
    assert rows["C1"]["customer_name"] == "Second" and rows["C1"]["region"] == "EMEA"
    assert rows["C2"] | {"customer_id": None} == {
        "customer_id": None,
        "customer_name": "Unknown Customer",
        "industry": "Unknown",
        "region": "Unknown",
        "country": "Usa",
        "signup_date": None,
        "acquisition_channel": "Unknown",
        "account_status": "Paused",
        "plan_name": "Enterprise",
        "billing_frequency": "Unknown",
    }
    assert rows["C3"]["signup_date"] is None and rows["C3"]["billing_frequency"] == "Annual"


def test_null_tokens_option_keeps_region_na(raw):
    rows = cleaning.clean_customers(raw("customers", {"customer_id": "C1", "region": "NA"}, null_tokens=("",)))
    assert rows.first()["region"] == "North America"


def subscription(key, **values):
    return {"subscription_id": key, "customer_id": "C1", "start_date": "2024-01-10", "mrr": "100", **values}


def test_subscriptions(raw):
    customers = cleaning.clean_customers(raw("customers", {"customer_id": "C1", "plan_name": "pro"}))
    rows = by(
        cleaning.clean_subscriptions(
            raw(
                "subscriptions",
                subscription("kept ", mrr="944.493", arr="1", currency="us$", discount_pct="x"),
                subscription("negative", mrr="-5"),
                subscription("text", mrr="5 dollars"),
                subscription("no start", start_date=""),
                subscription("backwards", end_date="2024-01-09"),
                # an open end beats an ended row of the same start
                subscription("open", end_date="", plan_name="growth"),
                subscription("open", end_date="2024-05-01", plan_name="basic"),
                # a later row with impossible dates does not beat a valid one
                subscription("bad later", mrr="1"),
                subscription("bad later", start_date="2024-03-01", end_date="2024-02-01", mrr="2"),
                # ties go to the last line of the file
                subscription("tie", mrr="10"),
                subscription("tie", mrr="30"),
                subscription("tie", mrr="20"),
                subscription("stranger", customer_id="C9"),
            ),
            customers,
        ),
        "subscription_id",
    )
    assert set(rows) == {"kept", "open", "bad later", "tie", "stranger"}
    assert rows["kept"]["arr"] == 11333.92 and rows["kept"]["currency"] == "USD" and rows["kept"]["discount_pct"] == 0
    assert rows["kept"]["plan_name"] == "Pro" and rows["stranger"]["plan_name"] == "Unknown"
    assert rows["open"]["end_date"] is None and rows["open"]["plan_name"] == "Growth"
    assert rows["bad later"]["mrr"] == 1 and rows["tie"]["mrr"] == 20


def test_invoices(raw):
    invoice = {"customer_id": "C1", "invoice_date": "2024-01-31", "amount": "10.005", "invoice_status": "Paid"}
    rows = by(
        cleaning.clean_invoices(
            raw(
                "invoices",
                {**invoice, "invoice_id": "early", "due_date": "2024-01-01", "tax": "1.1", "total_amount": "999"},
                {**invoice, "invoice_id": "none", "due_date": "", "amount": "", "invoice_status": "void "},
                {**invoice, "invoice_id": "fine", "due_date": "2024-02-10", "amount": "-3.25"},
                {**invoice, "invoice_id": "twice", "invoice_date": "2024-01-30", "amount": "1"},
                {**invoice, "invoice_id": "twice", "invoice_date": "2024-01-02", "amount": "2"},
                {**invoice, "invoice_id": "", "amount": "1"},
                {**invoice, "invoice_id": "undated", "invoice_date": "soon"},
                {**invoice, "invoice_id": "nobody", "customer_id": " "},
            )
        ),
        "invoice_id",
    )
    assert set(rows) == {"early", "none", "fine", "twice"}
    assert rows["early"]["due_date"] == dt.date(2024, 3, 1) and rows["early"]["total_amount"] == 11.1
    assert rows["none"]["due_date"] == dt.date(2024, 3, 1) and rows["none"]["is_void"] is True
    assert rows["none"]["amount"] == 0 and rows["none"]["total_amount"] == 0
    assert rows["fine"]["due_date"] == dt.date(2024, 2, 10) and rows["fine"]["total_amount"] == -3.25
    assert rows["twice"]["amount"] == 1 and rows["twice"]["is_void"] is False


def test_gl(raw):
    line = {"txn_date": "2024-01-05", "amount": "5", "account_name": "S&M "}
    rows = by(
        cleaning.clean_gl(
            raw(
                "gl",
                {**line, "gl_txn_id": "a", "dr_cr": "dr ", "entity": "saas us", "department": "it-ops", "memo": " "},
                {**line, "gl_txn_id": "b", "account_name": "Suspense", "account_code": "9999"},
                {**line, "gl_txn_id": "c", "amount": "n/a"},
                {**line, "gl_txn_id": "d", "account_name": ""},
            )
        ),
        "gl_txn_id",
    )
    assert set(rows) == {"a", "b", "d"}
    a = rows["a"]
    assert (a["dr_cr"], a["entity"], a["department"], a["memo"]) == ("DR", "SaaS US", "It-Ops", "Unknown")
    assert (a["account_name"], a["account_category"], a["account_code"]) == ("s&m", "Sales & Marketing", "Unknown")
    assert rows["b"]["account_category"] == "Other" and rows["b"]["account_code"] == "9999"
    assert rows["d"]["account_name"] == "unknown" and rows["d"]["account_category"] == "Other"


def test_sales_marketing(raw):
    campaign = {"period": "2024-01-15", "channel": "paid search", "spend": "-100.5", "leads": "", "won_customers": "4"}
    rows = cleaning.clean_sales_marketing(
        raw(
            "sales_marketing",
            campaign,
            {**campaign, "period": "2024-01-20"},
            {**campaign, "won_customers": "-1", "leads": "-3"},
            {**campaign, "period": ""},
        )
    ).collect()
    assert len(rows) == 2
    won = {r["won_customers"]: r for r in rows}
    assert won[4].period == dt.date(2024, 1, 1) and won[4].spend == 100.5 and won[4].leads == 0
    assert won[4].cac == 25.12 and won[4].campaign_name == "Unknown Campaign" and won[4].channel == "Paid Search"
    assert won[0].cac is None and won[0].leads == 0


def test_cash(raw):
    row = {"period": "2024-01-01", "entity": "SaaS HoldCo", "beginning_cash": "10", "ending_cash": "5"}
    rows = cleaning.clean_cash(
        raw("cash", row, {**row, "entity": "saas holdco ", "beginning_cash": "9", "ending_cash": ""}, {**row, "period": ""})
    ).collect()
    assert [tuple(r) for r in rows] == [(dt.date(2024, 1, 1), "SaaS HoldCo", 10.0, 9.0)]
