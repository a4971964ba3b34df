"""Month states: partial sums of every fact by month, from one pass over each.

A state row is (part, period, label, amount, rest, number). ``amount`` and ``rest`` add up to a sum that does not
depend on the order of rows; ``label`` tells ledger categories, cash entities and marketing measures apart;
``number`` counts members, or changes of their number. The rows of a month follow from facts of that month alone,
but for presence, which follows from all subscriptions; so a written table of states can be replaced by month, and
every KPI is a sum over a few rows per month.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping
from functools import reduce

from pyspark.sql import DataFrame

from saldo.functions.text import literals
from saldo.functions.values import exact_parts, first_month_index, month_index, month_of_index, month_start
from saldo.operators.aggregate import aggregate
from saldo.operators.presence import NEVER

# The statuses of a live subscription, and of one that has churned.
LIVE_STATUSES = ["Active", "Paused"]
CHURNED_STATUS = "Cancelled"


def _sums(x: str, prefix: str = "") -> dict[str, str]:
    whole, rest = exact_parts(x)
    return {f"{prefix}amount": f"sum({whole})", f"{prefix}rest": f"sum({rest})"}


def _states(df: DataFrame, part: str, label: str = "CAST(NULL AS STRING)", number: str = "CAST(NULL AS LONG)") -> DataFrame:
    return df.selectExpr(
        f"'{part}' AS part", "period", f"{label} AS label", "amount", "rest", f"{number} AS number"
    ).filter("period IS NOT NULL")


def revenue_states(revenue: DataFrame) -> DataFrame:
    """Recognised (not void) amounts; ``number`` counts the rows that are not void."""
    recognised = "CASE WHEN coalesce(is_void, false) THEN 0 ELSE amount END"
    kept = {"number": "count_if(NOT coalesce(is_void, false))"}
    return _states(aggregate(revenue, ["period"], {**_sums(recognised), **kept}), "revenue", number="number")


def ledger_states(gl: DataFrame) -> DataFrame:
    return _states(aggregate(gl, ["period", "account_category"], _sums("amount")), "ledger", label="account_category")


def cash_states(cash: DataFrame) -> DataFrame:
    return _states(aggregate(cash, ["period", "entity"], _sums("ending_cash")), "cash", label="entity")


def marketing_states(sales_marketing: DataFrame) -> DataFrame:
    """One row per month and measure."""
    measures = ["spend", "leads", "won_customers"]
    sums = reduce(dict.__or__, [_sums(m, f"{m}_") for m in measures])
    stacked = ", ".join(f"'{m}', {m}_amount, {m}_rest" for m in measures)
    months = aggregate(sales_marketing, ["period"], sums)
    rows = months.selectExpr("period", f"stack({len(measures)}, {stacked}) AS (measure, amount, rest)")
    return _states(rows, "marketing", label="measure")


def signup_states(customers: DataFrame) -> DataFrame:
    dated = customers.filter("signup_date IS NOT NULL")
    counted = aggregate(
        dated, [f"{month_start('signup_date')} AS period"], {"number": "count(DISTINCT customer_id)"}
    )
    none = "CAST(NULL AS DECIMAL(37, 12)) AS amount", "CAST(NULL AS DOUBLE) AS rest"
    return _states(counted.selectExpr("*", *none), "signups", number="number")


def subscription_states(subscriptions: DataFrame) -> DataFrame:
    """Bookings (customers, ARR), churned customers and changes of presence, from one pass over subscriptions.

    Each subscription counts in up to three parts. One aggregate leaves a row per part, customer and month, however
    many subscriptions a customer has. Presence counts +1 at the first month that no earlier interval of the
    customer covers, and -1 after its last; the other parts count customers.
    """
    whole, rest = exact_parts("arr")
    live = f"subscription_status IN ({literals(LIVE_STATUSES)}) AND customer_id IS NOT NULL"
    churned = f"subscription_status = '{CHURNED_STATUS}'"
    first, last = first_month_index("start_date"), f"coalesce({month_index('end_date')}, {NEVER})"
    parts = f"""inline(array(
        named_struct('part', 'bookings', 'month', {month_index('period')}, 'last', 0, 'amount', {whole}, 'rest', {rest}),
        named_struct('part', 'churned', 'month', CASE WHEN {churned} THEN {month_index('end_date')} END, 'last', 0,
            'amount', NULL, 'rest', NULL),
        named_struct('part', 'presence', 'month', CASE WHEN {live} AND {first} <= {last} THEN {first} END, 'last', {last},
            'amount', NULL, 'rest', NULL)))"""
    rows = subscriptions.selectExpr("customer_id", parts).filter("month IS NOT NULL")
    sums = {"last": "max(last)", "amount": "sum(amount)", "rest": "sum(rest)"}
    members = aggregate(rows, ["part", "customer_id", "month"], sums)
    earlier = "PARTITION BY part, customer_id ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    uncovered = members.selectExpr("*", f"greatest(month, max(last) OVER ({earlier}) + 1) AS first")
    none = "'amount', CAST(NULL AS DECIMAL(37, 12)), 'rest', CAST(NULL AS DOUBLE)"
    counted = f"""inline(CASE
        WHEN part <> 'presence' THEN
            array(named_struct('at', month, 'change', CAST(customer_id IS NOT NULL AS INT), 'amount', amount, 'rest', rest))
        WHEN first <= last THEN
            array(named_struct('at', first, 'change', 1, {none}), named_struct('at', last + 1, 'change', -1, {none}))
        END)"""
    changes = uncovered.selectExpr("part", counted).filter(f"at <= {NEVER}")
    by_month = ["part", f"{month_of_index('at')} AS period"]
    sums = {"amount": "sum(amount)", "rest": "sum(rest)", "number": "sum(change)"}
    return aggregate(changes, by_month, sums).selectExpr(
        "part",
        "period",
        "CAST(NULL AS STRING) AS label",
        "amount",
        "rest",
        "CASE WHEN part = 'bookings' THEN coalesce(number, 0) ELSE number END AS number",
    )


# How each group of parts follows from its fact.
BUILDERS = {
    "fact_revenue": revenue_states,
    "fact_subscription": subscription_states,
    "fact_gl": ledger_states,
    "fact_sales_marketing": marketing_states,
    "fact_cash": cash_states,
    "dim_customer": signup_states,
}
#: What the KPI view reads; the base table reads signups as well.
VIEW_FACTS = tuple(name for name in BUILDERS if name != "dim_customer")


def month_states(star: Mapping[str, DataFrame], facts: Collection[str] = tuple(BUILDERS)) -> DataFrame:
    """The states of the given tables of a star schema, each read once."""
    shape = ["part", "period", "label", "CAST(amount AS DECIMAL(38, 12)) AS amount", "rest", "number"]
    return reduce(DataFrame.unionByName, [BUILDERS[name](star[name]).selectExpr(*shape) for name in facts])


def replaced_months(states: DataFrame, recomputed: DataFrame) -> DataFrame:
    """States in which the parts and months that were computed anew take the place of the former ones.

    Presence depends on all subscriptions, so it must be among the recomputed parts with all its months.
    """
    anew = recomputed.select("part", "period").distinct()
    return states.join(anew, ["part", "period"], "left_anti").select(recomputed.columns).unionByName(recomputed)
