"""Clean tables to a month-grained star schema."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from saldo.functions.values import month_start
from saldo.operators.aggregate import aggregate
from saldo.plans import cleaning
from saldo.sources.tables import LazyTables

# Date columns that feed the date dimension. Dates need neither a
# subscription's plan nor unique campaign and cash rows.
DATE_COLUMNS = {
    "customers": ["signup_date"],
    "valid_subscriptions": ["start_date", "end_date"],
    "invoices": ["invoice_date", "due_date"],
    "gl": ["txn_date"],
    "campaigns": ["period"],
    "balances": ["period"],
}


# Days of one bitmap: what Spark's bitmap functions hold in a bucket.
_BITMAP_BYTES = 4096


def date_bitmaps(dates: DataFrame) -> DataFrame:
    """Bitmaps of the days in column ``date_key``: (bucket, days), a row for each 90 years that occur.

    Bitmaps are built by a sort, so days become distinct first, in hash tables that hold no more than the days that
    occur however many rows a task has. Bitmaps of several tables or builds merge by ``bitmap_or_agg``.
    """
    day = "unix_date(date_key)"
    placed = dates.filter("date_key IS NOT NULL").select("date_key").distinct().selectExpr(
        f"bitmap_bucket_number({day}) AS bucket", f"bitmap_bit_position({day}) AS position"
    )
    return aggregate(placed, ["bucket"], {"days": "bitmap_construct_agg(position)"})


def days_of_bitmaps(bitmaps: DataFrame) -> DataFrame:
    """The days that bitmaps hold, each once: (date_key)."""
    byte = "CAST(conv(hex(substr(days, k + 1, 1)), 16, 10) AS INT)"
    day = f"CASE WHEN bucket > 0 THEN (bucket - 1) * {8 * _BITMAP_BYTES} + position + 1 ELSE bucket * {8 * _BITMAP_BYTES} - position END"
    return (
        bitmaps.selectExpr("bucket", "days", f"explode(sequence(0, {_BITMAP_BYTES - 1})) AS k")
        .selectExpr("bucket", "k", f"{byte} AS byte")
        .filter("byte > 0")
        .selectExpr("bucket", "explode(transform(filter(sequence(0, 7), b -> getbit(byte, b) = 1), b -> 8 * k + b)) AS position")
        .selectExpr(f"date_from_unix_date(CAST({day} AS INT)) AS date_key")
    )


def dim_date(clean: Mapping[str, DataFrame]) -> DataFrame:
    """Every date that occurs in a clean table, with its calendar attributes.

    Each table is read once for all its dates, which become bits of a few bitmaps.
    """
    dates = [
        clean[table].selectExpr(f"stack({len(columns)}, {', '.join(columns)}) AS date_key")
        for table, columns in DATE_COLUMNS.items()
    ]
    days = days_of_bitmaps(date_bitmaps(reduce(DataFrame.union, dates)))
    return days.selectExpr("date_key", *_calendar("date_key"), f"{month_start('date_key')} AS month_start")


def dim_month(dates: DataFrame) -> DataFrame:
    months = dates.select("month_start").distinct()
    return months.selectExpr("month_start", *_calendar("month_start")).orderBy("month_start")


def _calendar(d: str) -> list[str]:
    return [
        f"year({d}) AS year",
        f"month({d}) AS month_num",
        f"date_format({d}, 'yyyy-MM') AS year_month",
        f"quarter({d}) AS quarter_num",
    ]


# Fixed values, from here to the builders: the columns of each table, in order.


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_name",
        "industry",
        "region",
        "country",
        "signup_date",
        "acquisition_channel",
        "account_status",
        "plan_name",
        "billing_frequency",
    )


def dim_plan(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.filter("plan_name is not null").select("plan_name").distinct()


def dim_account(gl: DataFrame) -> DataFrame:
    """One row per account code; name and category are smallest values of their own."""
    smallest = {"account_name": "min(account_name)", "account_category": "min(account_category)"}
    return aggregate(gl.filter("account_code IS NOT NULL"), ["account_code"], smallest)


def fact_revenue(invoices: DataFrame) -> DataFrame:
    return invoices.selectExpr(
        "invoice_id",
        "customer_id",
        "subscription_id",
        "invoice_date",
        f"{month_start('invoice_date')} AS period",
        "due_date",
        "amount",
        "tax",
        "total_amount",
        "invoice_status",
        "is_void",
    )


def fact_subscription(subscriptions: DataFrame) -> DataFrame:
    return subscriptions.selectExpr(
        "subscription_id",
        "customer_id",
        "start_date",
        f"{month_start('start_date')} AS period",
        "end_date",
        "plan_name",
        "mrr",
        "arr",
        "subscription_status",
        "discount_pct",
        "currency",
    )


def fact_gl(gl: DataFrame) -> DataFrame:
    return gl.selectExpr(
        "gl_txn_id",
        "txn_date",
        f"{month_start('txn_date')} AS period",
        "account_code",
        "account_name",
        "account_category",
        "department",
        "cost_center",
        "vendor_customer",
        "amount",
        "dr_cr",
        "entity",
        "memo",
    )


def fact_sales_marketing(sales_marketing: DataFrame) -> DataFrame:
    return sales_marketing.select("period", "channel", "campaign_name", "spend", "leads", "won_customers", "cac")


def fact_cash(cash: DataFrame) -> DataFrame:
    return cash.select("period", "entity", "beginning_cash", "ending_cash")


# How each table of the schema follows from the clean tables, in build order.
BUILDERS = {
    "dim_date": dim_date,
    "dim_month": lambda clean: dim_month(dim_date(clean)),
    "dim_customer": lambda clean: dim_customer(clean["customers"]),
    "dim_plan": lambda clean: dim_plan(clean["subscriptions"]),
    "dim_account": lambda clean: dim_account(clean["gl"]),
    "fact_revenue": lambda clean: fact_revenue(clean["invoices"]),
    "fact_subscription": lambda clean: fact_subscription(clean["subscriptions"]),
    "fact_gl": lambda clean: fact_gl(clean["gl"]),
    "fact_sales_marketing": lambda clean: fact_sales_marketing(clean["sales_marketing"]),
    "fact_cash": lambda clean: fact_cash(clean["cash"]),
}


def kpi_facts(clean: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """What the month states read, from clean tables that may hold no more than that."""
    subscription = ["customer_id", "start_date", "end_date", "arr", "subscription_status"]
    return {
        "fact_revenue": clean["invoices"].selectExpr(f"{month_start('invoice_date')} AS period", "amount", "is_void"),
        "fact_subscription": clean["valid_subscriptions"].selectExpr(*subscription, f"{month_start('start_date')} AS period"),
        "fact_gl": clean["gl"].selectExpr(f"{month_start('txn_date')} AS period", "account_category", "amount"),
        "fact_sales_marketing": clean["sales_marketing"].select("period", "spend", "leads", "won_customers"),
        "fact_cash": clean["cash"].select("period", "entity", "ending_cash"),
        "dim_customer": clean["customers"].select("customer_id", "signup_date"),
    }


# The keys by which written tables of the schema are bucketed.
KEYS = {
    "dim_customer": ("customer_id",),
    "fact_revenue": ("invoice_id",),
    "fact_subscription": ("subscription_id",),
    "fact_gl": ("gl_txn_id",),
}


def kpi_star(clean: Mapping[str, DataFrame]) -> Mapping[str, DataFrame]:
    """The tables that the KPIs read. None of them looks at a plan, so they skip the plan lookup."""

    def table(name: str) -> DataFrame:
        if name == "fact_subscription":
            return fact_subscription(clean["valid_subscriptions"])
        return BUILDERS[name](clean)

    return LazyTables(table)


# The tables whose rows the mart check counts.
COUNTED_TABLES = (
    "dim_customer",
    "dim_plan",
    "dim_account",
    "fact_revenue",
    "fact_subscription",
    "fact_gl",
    "fact_sales_marketing",
    "fact_cash",
)


# The raw table of each table with one row per key, its rows before the dedup, and the key.
KEYED = {
    "dim_customer": ("customers", cleaning.keyed_customers, "customer_id"),
    "fact_revenue": ("invoices", cleaning.keyed_invoices, "invoice_id"),
    "fact_subscription": ("subscriptions", cleaning.keyed_subscriptions, "subscription_id"),
    "fact_gl": ("gl", cleaning.keyed_gl, "gl_txn_id"),
}


def mart_row_counts(star: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table; of written tables only the file footers are read."""
    counts = [
        star[name].selectExpr("count(*) AS row_count").selectExpr(f"'{name}' AS table_name", "row_count")
        for name in COUNTED_TABLES
    ]
    return reduce(DataFrame.unionByName, counts)


def kept_row_counts(raw: Mapping[str, DataFrame], clean: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table of a star schema that is not written.

    A table with one row per key has as many rows as keys, whichever row is kept, so these are counted before the
    dedup, which would sort and shuffle whole rows.
    """

    def table(name: str) -> DataFrame:
        if name in KEYED:
            source, keyed, key = KEYED[name]
            return keyed(raw[source]).select(key).distinct()
        return BUILDERS[name](clean)

    return mart_row_counts(LazyTables(table))
