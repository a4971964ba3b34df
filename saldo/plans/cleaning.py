"""Raw tables to clean tables.

Inputs may be all text (CSV scan) or typed; both end in the same schema. Dedup
only needs the key, the dates and the columns that invalidate a row, so it comes
first and the remaining columns are standardized on the rows that it keeps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from saldo.functions import text as X
from saldo.functions.values import month_start, parse_date, parse_number, round2
from saldo.operators.aggregate import aggregate
from saldo.operators.dedup import keep_first, keep_last


def _replace(df: DataFrame, **columns: str) -> DataFrame:
    return df.selectExpr(*[f"{columns[c]} AS {c}" if c in columns else c for c in df.columns])


def keyed_customers(raw: DataFrame) -> DataFrame:
    """Customers before the dedup, with their key and date."""
    return _replace(raw, customer_id=X.clean_id(raw, "customer_id"), signup_date=parse_date(raw, "signup_date"))


def clean_customers(raw: DataFrame) -> DataFrame:
    """One row per customer: the earliest signup."""
    first = keep_first(keyed_customers(raw), "customer_id", ["signup_date"])
    return X.trim_text_columns(first, "customer_id").selectExpr(
        "customer_id",
        f"coalesce({X.title_case('customer_name')}, 'Unknown Customer') AS customer_name",
        f"coalesce({X.title_case('industry')}, 'Unknown') AS industry",
        f"{X.std_region('region')} AS region",
        f"coalesce({X.title_case('country')}, 'Unknown') AS country",
        "signup_date",
        f"{X.std_channel('acquisition_channel')} AS acquisition_channel",
        f"{X.std_status('account_status')} AS account_status",
        f"{X.std_plan('plan_name')} AS plan_name",
        f"{X.std_billing('billing_frequency')} AS billing_frequency",
    )


def keyed_subscriptions(raw: DataFrame) -> DataFrame:
    """Subscriptions with a positive MRR and possible dates, before the dedup."""
    return _replace(
        raw.drop("arr"),
        subscription_id=X.clean_id(raw, "subscription_id"),
        start_date=parse_date(raw, "start_date"),
        end_date=parse_date(raw, "end_date"),
        mrr=parse_number(raw, "mrr"),
    ).filter("mrr > 0 AND start_date IS NOT NULL AND (end_date IS NULL OR end_date >= start_date)")


def valid_subscriptions(raw: DataFrame) -> DataFrame:
    """One row per subscription: positive MRR, possible dates, the latest start wins.

    An open end sorts after every date, so it wins over an ended row of the same
    start. The plan is the row's own; ``fill_plans`` looks missing ones up.
    """
    last = keep_last(keyed_subscriptions(raw), "subscription_id", ["start_date", "end_date"])
    t = X.trim_text_columns(last, "subscription_id")
    return t.selectExpr(
        "subscription_id",
        f"{X.std_id('customer_id')} AS customer_id",
        "start_date",
        "end_date",
        f"{X.std_plan('plan_name')} AS plan_name",
        "mrr",
        f"{round2('mrr * 12')} AS arr",
        f"{X.std_status('subscription_status')} AS subscription_status",
        f"coalesce({parse_number(t, 'discount_pct')}, 0) AS discount_pct",
        f"{X.std_currency('currency')} AS currency",
    )


def subscription_intervals(raw: DataFrame) -> DataFrame:
    """``valid_subscriptions`` down to customers, dates and statuses; columns that cannot decide about these are not sorted."""
    needed = ["customer_id", "subscription_status"]
    kept = keep_last(keyed_subscriptions(raw), "subscription_id", ["start_date", "end_date"], needed)
    t = X.trim_text_columns(kept, "subscription_id")
    return t.selectExpr(
        f"{X.std_id('customer_id')} AS customer_id",
        "start_date",
        "end_date",
        f"{X.std_status('subscription_status')} AS subscription_status",
    )


# Parts that a customer's subscriptions are spread over for the plan lookup.
LOOKUP_PARTS = 64


def fill_plans(subscriptions: DataFrame, customers: DataFrame) -> DataFrame:
    """Take the customer's plan where the subscription has none.

    Only rows without a plan, and with a customer to ask for it, take part in the
    lookup. They are spread over parts of their customer, and the plan is fetched
    once per customer and part, so that a hot customer is not one task's.
    """
    asks = "plan_name = 'Unknown' AND customer_id IS NOT NULL"
    part = f"pmod(xxhash64(subscription_id), {LOOKUP_PARTS}) AS _part"
    without = subscriptions.filter(asks).selectExpr("*", part)
    plans = customers.selectExpr("customer_id", "plan_name AS customer_plan")
    found = without.select("customer_id", "_part").distinct().join(plans, "customer_id")
    filled = "coalesce(customer_plan, 'Unknown') AS plan_name"
    looked_up = without.join(found, ["customer_id", "_part"], "left").selectExpr(
        *[filled if c == "plan_name" else c for c in subscriptions.columns]
    )
    return subscriptions.filter(f"NOT ({asks})").unionByName(looked_up)


def clean_subscriptions(raw: DataFrame, customers: DataFrame) -> DataFrame:
    """Valid subscriptions with plans filled from clean customers.

    Customers are unique, so the lookup changes no row count and may run on the
    fewer rows that the filters and the dedup leave.
    """
    return fill_plans(valid_subscriptions(raw), customers)


def keyed_invoices(raw: DataFrame) -> DataFrame:
    """Invoices with an id, a customer and a date, before the dedup."""
    named = raw.drop("total_amount").filter(f"{X.has_text(raw, 'invoice_id')} AND {X.has_text(raw, 'customer_id')}")
    return _replace(
        named, invoice_id=X.clean_id(raw, "invoice_id"), invoice_date=parse_date(raw, "invoice_date")
    ).filter("invoice_date IS NOT NULL")


def _repaired_due(invoices: DataFrame) -> str:
    due = parse_date(invoices, "due_date")
    return f"CASE WHEN {due} >= invoice_date THEN {due} ELSE date_add(invoice_date, 30) END"


def clean_invoices(raw: DataFrame) -> DataFrame:
    """One row per invoice: the latest date; due dates and totals repaired, void rows flagged."""
    t = X.trim_text_columns(keep_last(keyed_invoices(raw), "invoice_id", ["invoice_date"]), "invoice_id")
    return t.selectExpr(
        "invoice_id",
        f"{X.std_id('customer_id')} AS customer_id",
        f"{X.std_id('subscription_id')} AS subscription_id",
        "invoice_date",
        f"{_repaired_due(t)} AS due_date",
        f"coalesce({parse_number(t, 'amount')}, 0) AS amount",
        f"coalesce({parse_number(t, 'tax')}, 0) AS tax",
        f"{X.std_status('invoice_status')} AS invoice_status",
    ).selectExpr("*", f"{round2('amount + tax')} AS total_amount", "invoice_status = 'Void' AS is_void")


def keyed_gl(raw: DataFrame) -> DataFrame:
    """Ledger rows with an id, a date and an amount, before the dedup."""
    return _replace(
        raw.filter(X.has_text(raw, "gl_txn_id")),
        gl_txn_id=X.clean_id(raw, "gl_txn_id"),
        txn_date=parse_date(raw, "txn_date"),
        amount=parse_number(raw, "amount"),
    ).filter("txn_date IS NOT NULL AND amount IS NOT NULL")


def clean_gl(raw: DataFrame) -> DataFrame:
    """One row per ledger transaction: the latest date; accounts mapped to categories."""
    return (
        X.trim_text_columns(keep_last(keyed_gl(raw), "gl_txn_id", ["txn_date"]), "gl_txn_id")
        .selectExpr(
            "gl_txn_id",
            "txn_date",
            f"coalesce({X.std_id('account_code')}, 'Unknown') AS account_code",
            "lower(coalesce(account_name, 'Unknown')) AS account_name",
            f"coalesce({X.title_case('department')}, 'Unknown') AS department",
            "coalesce(cost_center, 'Unknown') AS cost_center",
            "coalesce(vendor_customer, 'Unknown') AS vendor_customer",
            "amount",
            f"{X.std_side('dr_cr')} AS dr_cr",
            f"{X.std_entity('entity')} AS entity",
            "coalesce(memo, 'Unknown') AS memo",
        )
        .selectExpr("*", f"{X.gl_category('account_name')} AS account_category")
    )


def ledger_amounts(raw: DataFrame) -> DataFrame:
    """``clean_gl`` down to dates, amounts and categories; columns that cannot decide about these are not sorted."""
    kept = keep_last(keyed_gl(raw), "gl_txn_id", ["txn_date"], ["account_name", "amount"])
    t = X.trim_text_columns(kept, "gl_txn_id").selectExpr(
        "gl_txn_id", "txn_date", "amount", "lower(coalesce(account_name, 'Unknown')) AS account_name"
    )
    return t.selectExpr("gl_txn_id", "txn_date", "amount", f"{X.gl_category('account_name')} AS account_category")


def campaigns(raw: DataFrame) -> DataFrame:
    """Month-grain campaign rows, duplicates included."""
    t = X.trim_text_columns(raw)
    return t.selectExpr(
        f"{month_start(parse_date(t, 'period'))} AS period",
        f"{X.std_channel('channel')} AS channel",
        "coalesce(campaign_name, 'Unknown Campaign') AS campaign_name",
        f"abs(coalesce({parse_number(t, 'spend')}, 0)) AS spend",
        f"greatest(coalesce({parse_number(t, 'leads')}, 0), 0) AS leads",
        f"greatest(coalesce({parse_number(t, 'won_customers')}, 0), 0) AS won_customers",
    ).filter("period IS NOT NULL")


def clean_sales_marketing(raw: DataFrame) -> DataFrame:
    """Month-grain campaign rows with CAC; exact duplicates dropped."""
    cac = f"CASE WHEN won_customers > 0 THEN {round2('spend / won_customers')} END AS cac"
    return campaigns(raw).dropDuplicates().selectExpr("*", cac)


def balances(raw: DataFrame) -> DataFrame:
    """Month-grain balances by entity, repetitions included; a missing ending is the beginning."""
    t = X.trim_text_columns(raw)
    beginning, ending = parse_number(t, "beginning_cash"), parse_number(t, "ending_cash")
    return t.selectExpr(
        f"{month_start(parse_date(t, 'period'))} AS period",
        f"{X.std_entity('entity')} AS entity",
        f"{beginning} AS beginning_cash",
        f"coalesce({ending}, {beginning}) AS ending_cash",
    ).filter("period IS NOT NULL")


def clean_cash(raw: DataFrame) -> DataFrame:
    """One row per month and entity with the largest balances."""
    largest = {"beginning_cash": "max(beginning_cash)", "ending_cash": "max(ending_cash)"}
    return aggregate(balances(raw), ["period", "entity"], largest)


# How each clean table follows from the raw tables, in build order.
BUILDERS = {
    "customers": lambda raw: clean_customers(raw["customers"]),
    "subscriptions": lambda raw: clean_subscriptions(raw["subscriptions"], clean_customers(raw["customers"])),
    "invoices": lambda raw: clean_invoices(raw["invoices"]),
    "gl": lambda raw: clean_gl(raw["gl"]),
    "sales_marketing": lambda raw: clean_sales_marketing(raw["sales_marketing"]),
    "cash": lambda raw: clean_cash(raw["cash"]),
}

# Steps before a clean table is complete, for readers that need no more of it.
STEPS = {
    "valid_subscriptions": lambda raw: valid_subscriptions(raw["subscriptions"]),
    "campaigns": lambda raw: campaigns(raw["sales_marketing"]),
    "balances": lambda raw: balances(raw["cash"]),
}


def invoice_dates(raw: DataFrame) -> DataFrame:
    """The dates of ``clean_invoices``, a row per invoice; a repaired due date depends on which row is kept."""
    kept = keep_last(keyed_invoices(raw), "invoice_id", ["invoice_date"], ["due_date"])
    t = X.trim_text_columns(kept, "invoice_id")
    return t.selectExpr("invoice_date", f"{_repaired_due(t)} AS due_date")


def subscription_dates(raw: DataFrame) -> DataFrame:
    """The dates of ``valid_subscriptions``, a row per subscription.

    Both dates are one number, the start in its upper half and an open end as the largest lower half, so the row that
    is kept holds the largest.
    """
    both = "shiftleft(CAST(unix_date(start_date) AS BIGINT), 32) + coalesce(unix_date(end_date) + 2147483648, 4294967295)"
    latest = aggregate(keyed_subscriptions(raw), ["subscription_id"], {"latest": f"max({both})"})
    end = "CAST((latest & 4294967295) - 2147483648 AS INT)"
    return latest.selectExpr(
        "date_from_unix_date(CAST(shiftright(latest, 32) AS INT)) AS start_date",
        f"CASE WHEN (latest & 4294967295) <> 4294967295 THEN date_from_unix_date({end}) END AS end_date",
    )


# The dates of the rows that clean tables keep, without sorting and shuffling the rows themselves. Where the
# order of the dedup starts with the date, its extreme is the kept row's.
DATES = {
    "customers": lambda raw: aggregate(
        keyed_customers(raw["customers"]), ["customer_id"], {"signup_date": "min(signup_date)"}
    ),
    "valid_subscriptions": lambda raw: subscription_dates(raw["subscriptions"]),
    "invoices": lambda raw: invoice_dates(raw["invoices"]),
    "gl": lambda raw: aggregate(keyed_gl(raw["gl"]), ["gl_txn_id"], {"txn_date": "max(txn_date)"}),
    "campaigns": STEPS["campaigns"],
    "balances": STEPS["balances"],
}
