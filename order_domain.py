"""Raw finance tables derived from an order-processing schema.

Customers stay customers, an order is a subscription, a line item is an invoice
and a ledger line; orders also stand in for campaigns and cash reports. The
defects that cleaning must repair (spellings, blanks, NULLs, sign flips, copies)
follow from the row's own key, so every row of the source takes part and each
run sees the same data.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from saldo.functions.values import round2
from saldo.operators.aggregate import aggregate
from saldo.sources.tables import LazyTables, dealt_out

Tables = Mapping[str, DataFrame]


# Schemas of the order tables; stating them spares a scan of file footers per table.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
}


# The key by which the largest table is dealt out where it comes in few files.
DEALT_BY = {"lineitem": "l_orderkey"}

# Orders that a task gets where each becomes a row of its own that is sorted or aggregated in the scan. The date
# beside the key spreads orders that share a key or have none.
ORDERS_A_TASK = 1 << 20


def source_tables(spark: SparkSession, folder: str) -> Tables:
    """The order tables of a folder, each read when first used."""

    def table(name: str) -> DataFrame:
        df = spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")
        return dealt_out(df, DEALT_BY[name]) if name in DEALT_BY else df

    return LazyTables(table)


def _pick(key: str, *values: str | float | None) -> str:
    """The list entry at the key's remainder."""
    items = ", ".join("NULL" if v is None else f"'{v}'" if isinstance(v, str) else f"{v}D" for v in values)
    return f"array({items})[CAST({key} % {len(values)} AS INT)]"


def _null_at(key: str, every: int, value: str) -> str:
    return f"CASE WHEN {key} % {every} <> 0 THEN {value} END"


def _copies(df: DataFrame, key: str, every: int) -> DataFrame:
    """Repeat the rows of some keys once, numbered by ``copy``."""
    return df.selectExpr("*", f"explode(CASE WHEN {key} % {every} = 0 THEN array(0, 1) ELSE array(0) END) AS copy")


def _padded(key: str, every: int) -> str:
    return f"concat(CAST({key} AS STRING), CASE WHEN {key} % {every} = 0 THEN ' ' ELSE '' END)"


def raw_customers(tables: Tables) -> DataFrame:
    first_order = aggregate(
        tables["orders"], ["o_custkey AS c_custkey"], {"first_order": "min(CAST(o_orderdate AS DATE))"}
    )
    nation = tables["nation"].selectExpr("n_nationkey AS c_nationkey", "n_name", "n_regionkey")
    region = tables["region"].selectExpr("r_regionkey AS n_regionkey", "r_name")
    customer = _copies(tables["customer"], "c_custkey", 50)
    joined = customer.join(nation, "c_nationkey").join(region, "n_regionkey").join(first_order, "c_custkey", "left")
    region_spelling = f"""CASE r_name
        WHEN 'AMERICA' THEN {_pick('c_custkey', 'North America', 'north america', 'NA')}
        WHEN 'EUROPE' THEN {_pick('c_custkey', 'EMEA', 'emea ')}
        WHEN 'ASIA' THEN {_pick('c_custkey', 'APAC', 'apac')}
        ELSE r_name END"""
    channel = _pick("c_custkey", "Organic", "Paid Search", "Partner", "Outbound", "Referral", "paid search", "REFERRAL")
    plan = _pick("c_custkey", "Basic", "Growth", "Pro", "Enterprise", "enterprise ")
    return joined.selectExpr(
        f"{_padded('c_custkey', 13)} AS customer_id",
        "CASE WHEN copy = 1 THEN upper(c_name) ELSE c_name END AS customer_name",
        f"{_null_at('c_custkey', 10, 'c_mktsegment')} AS industry",
        f"{region_spelling} AS region",
        f"{_null_at('c_custkey', 20, 'n_name')} AS country",
        f"{_null_at('c_custkey', 33, 'first_order')} AS signup_date",
        f"{channel} AS acquisition_channel",
        f"{_pick('c_custkey', 'Active', 'Churned', 'active', 'ACTIVE ', ' paused ', None)} AS account_status",
        f"{_null_at('c_custkey', 40, plan)} AS plan_name",
        f"{_pick('c_custkey', 'Monthly', 'Annual', 'monthly', 'annual')} AS billing_frequency",
    )


def raw_subscriptions(tables: Tables) -> DataFrame:
    start = "CAST(o_orderdate AS DATE)"
    end = f"""CASE WHEN o_orderkey % 33 = 0 THEN date_sub({start}, 30)
        WHEN o_orderstatus = 'F' THEN date_add({start}, CAST(o_orderkey % 420 + 120 AS INT)) END"""
    price = round2("o_totalprice / 1000")
    mrr = f"CASE WHEN o_orderkey % 31 = 0 THEN -{price} ELSE {price} END * CASE WHEN copy = 1 THEN 1.1D ELSE 1D END"
    status = f"""CASE o_orderstatus WHEN 'F' THEN {_pick('o_orderkey', 'cancelled', 'CANCELLED')}
        WHEN 'O' THEN {_pick('o_orderkey', 'Active', 'active')} ELSE 'paused ' END"""
    plan = _pick("o_orderkey", "Basic", "Growth", "Pro", "Enterprise", "enterprise ")
    orders = dealt_out(tables["orders"], "o_orderkey", "o_orderdate", rows=ORDERS_A_TASK, spread=False)
    return _copies(orders, "o_orderkey", 50).selectExpr(
        f"{_padded('o_orderkey', 7)} AS subscription_id",
        f"{_padded('o_custkey', 13)} AS customer_id",
        f"{_null_at('o_orderkey', 97, start)} AS start_date",
        f"{end} AS end_date",
        f"{_null_at('o_orderkey', 40, plan)} AS plan_name",
        f"{_null_at('o_orderkey', 71, mrr)} AS mrr",
        f"{mrr} * 12 AS arr",
        f"{_null_at('o_orderkey', 29, status)} AS subscription_status",
        f"{_pick('o_orderkey', 0.0, 5.0, 10.0, 15.0, 20.0, None)} AS discount_pct",
        f"{_pick('o_orderkey', 'USD', 'usd', 'Usd', 'US$', 'CAD', 'cad', None)} AS currency",
    )


def raw_invoices(tables: Tables) -> DataFrame:
    orders = tables["orders"].selectExpr("o_orderkey AS l_orderkey", "o_custkey", "o_orderdate")
    amount = round2("l_extendedprice * (1 - l_discount)")
    tax = round2(f"{amount} * l_tax")
    status = "CASE l_returnflag WHEN 'R' THEN 'VOID' WHEN 'A' THEN 'paid' ELSE 'Open ' END"
    return (
        tables["lineitem"]
        .join(orders, "l_orderkey")
        .selectExpr(
            "concat_ws('-', l_orderkey, l_linenumber) AS invoice_id",
            f"{_padded('o_custkey', 13)} AS customer_id",
            "CAST(l_orderkey AS STRING) AS subscription_id",
            f"{_null_at('l_partkey', 101, 'CAST(l_shipdate AS DATE)')} AS invoice_date",
            f"{_null_at('l_partkey', 47, 'date_add(CAST(o_orderdate AS DATE), 30)')} AS due_date",
            f"{amount} AS amount",
            f"{_null_at('l_suppkey', 43, tax)} AS tax",
            f"{round2(f'{amount} + {tax} + CASE WHEN l_partkey % 20 = 0 THEN 12.34D ELSE 0D END')} AS total_amount",
            f"{_null_at('l_partkey', 37, status)} AS invoice_status",
        )
    )


# Ledger account code and two spellings of its name, by part type.
_ACCOUNTS = {
    "ECONOMY": ("5000", "Cost of Service", "cost of service "),
    "LARGE": ("6100", "Sales and Marketing", "S&M"),
    "MEDIUM": ("6200", "Research and Development", "R&D"),
    "PROMO": ("6300", "General and Administrative", "g&a"),
    "SMALL": ("1010", "Cash", "cash"),
    "STANDARD": ("9999", "Misc Expense", "Suspense"),
}


def _by_part_type(entry: int) -> str:
    whens = [f"WHEN '{part_type}' THEN '{account[entry]}'" for part_type, account in _ACCOUNTS.items()]
    return f"CASE p_type {' '.join(whens)} END"


def raw_gl(tables: Tables) -> DataFrame:
    part = tables["part"].selectExpr("p_partkey AS l_partkey", "p_type", "p_brand")
    supplier = tables["supplier"].selectExpr("s_suppkey AS l_suppkey", "s_name", "s_nationkey")
    joined = tables["lineitem"].join(part, "l_partkey").join(supplier, "l_suppkey")
    name = f"CASE WHEN l_linenumber % 2 = 0 THEN {_by_part_type(1)} ELSE {_by_part_type(2)} END"
    amount = "CASE WHEN l_linestatus = 'F' THEN -l_extendedprice ELSE l_extendedprice END"
    memo = "concat('order ', CAST(l_orderkey AS STRING))"
    return joined.selectExpr(
        "concat('GL', concat_ws('-', l_orderkey, l_linenumber)) AS gl_txn_id",
        "CAST(l_shipdate AS DATE) AS txn_date",
        f"{_null_at('l_partkey', 33, _by_part_type(0))} AS account_code",
        f"{_null_at('l_partkey', 59, name)} AS account_name",
        f"{_null_at('l_partkey', 19, 'p_brand')} AS department",
        "CASE WHEN l_suppkey % 10 = 0 THEN '' ELSE concat('CC', CAST(l_suppkey % 10 AS STRING)) END AS cost_center",
        f"{_null_at('l_suppkey', 23, 's_name')} AS vendor_customer",
        f"{_null_at('l_partkey', 89, amount)} AS amount",
        f"{_pick('l_orderkey', 'DR', 'CR', 'dr', 'cr ', None)} AS dr_cr",
        f"{_pick('s_nationkey', 'SaaS HoldCo', 'SaaS Canada', 'SaaS US', 'saas us')} AS entity",
        f"{_null_at('l_orderkey', 11, memo)} AS memo",
    )


def raw_sales_marketing(tables: Tables) -> DataFrame:
    campaign = "concat('Campaign ', o_orderpriority)"
    channel = _pick("o_orderkey", "Paid Search", "LinkedIn", "Partner", "Outbound", "Organic", "paid search", "PARTNER")
    return _copies(tables["orders"], "o_orderkey", 60).selectExpr(
        f"{_null_at('o_orderkey', 51, 'CAST(o_orderdate AS DATE)')} AS period",
        f"{channel} AS channel",
        f"{_null_at('o_orderkey', 20, campaign)} AS campaign_name",
        "CASE WHEN o_orderkey % 25 = 0 THEN -o_totalprice ELSE o_totalprice END AS spend",
        f"{_null_at('o_orderkey', 33, 'CAST(o_orderkey % 500 AS DOUBLE)')} AS leads",
        "CAST(o_orderkey % 40 - 1 AS DOUBLE) AS won_customers",
    )


def raw_cash(tables: Tables) -> DataFrame:
    customer = tables["customer"].selectExpr("c_custkey AS o_custkey", "c_nationkey", "c_acctbal")
    nation = tables["nation"].selectExpr("n_nationkey AS c_nationkey", "n_regionkey")
    joined = tables["orders"].join(customer, "o_custkey").join(nation, "c_nationkey")
    entity = _pick("n_regionkey", "SaaS HoldCo", "saas us", "SaaS Canada", "saas holdco", "SaaS HoldCo ")
    return joined.selectExpr(
        f"{_null_at('o_orderkey', 53, 'CAST(o_orderdate AS DATE)')} AS period",
        f"{entity} AS entity",
        "c_acctbal AS beginning_cash",
        f"{_null_at('o_orderkey', 25, 'o_totalprice')} AS ending_cash",
    )


# How each raw table follows from the order tables.
BUILDERS = {
    "customers": raw_customers,
    "subscriptions": raw_subscriptions,
    "invoices": raw_invoices,
    "gl": raw_gl,
    "sales_marketing": raw_sales_marketing,
    "cash": raw_cash,
}
