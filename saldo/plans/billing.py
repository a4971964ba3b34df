"""Invoices that follow from a subscription's terms."""

from __future__ import annotations

from pyspark.sql import DataFrame

from saldo.functions import text as X
from saldo.functions.values import parse_date, parse_number, round2
from saldo.operators.dedup import SEQ, keep_first

# The tax rate and payment term of a scheduled invoice.
TAX_RATE = 0.05
PAYMENT_DAYS = 30


def billing_schedule(subscriptions: DataFrame, horizon: str) -> DataFrame:
    """One invoice per month start from the subscription's start to its end or the horizon.

    A subscription that ends before it starts is billed once, on its start date;
    of several rows with one id, the first is billed.
    """
    t = X.trim_text_columns(subscriptions)
    discounted = f"coalesce({parse_number(t, 'mrr')}, 0) * (1 - coalesce({parse_number(t, 'discount_pct')}, 0) / 100)"
    terms = t.selectExpr(
        f"{X.std_id('subscription_id')} AS subscription_id",
        f"{X.std_id('customer_id')} AS customer_id",
        f"{parse_date(t, 'start_date')} AS start_date",
        f"coalesce({parse_date(t, 'end_date')}, DATE'{horizon}') AS until",
        f"{round2(discounted)} AS amount",
        *([SEQ] if SEQ in t.columns else []),
    )
    first_month = "trunc(add_months(date_sub(start_date, 1), 1), 'month')"
    months = f"""CASE WHEN until < start_date THEN array(start_date)
        WHEN {first_month} <= until THEN sequence({first_month}, until, INTERVAL 1 MONTH) END"""
    tax = round2(f"amount * {TAX_RATE}D")
    return (
        keep_first(terms, "subscription_id", [])
        .filter("start_date IS NOT NULL")
        .selectExpr("*", f"explode({months}) AS invoice_date")
        .selectExpr(
            "concat(subscription_id, date_format(invoice_date, '-yyyyMM')) AS invoice_id",
            "customer_id",
            "subscription_id",
            "invoice_date",
            f"date_add(invoice_date, {PAYMENT_DAYS}) AS due_date",
            "amount",
            f"{tax} AS tax",
            f"{round2(f'amount + {tax}')} AS total_amount",
        )
    )
