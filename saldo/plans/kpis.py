"""Monthly finance KPIs over the star schema.

Facts are reduced to one row per month before anything is combined, so the
merges, windows and formulas only ever see month-grain rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.functions.text import literals
from saldo.functions.values import exact_sum, month_start, ratio, round2
from saldo.operators.aggregate import aggregate
from saldo.operators.merge import merge_on_period
from saldo.operators.presence import presence_changes, running_presence
from saldo.plans.months import CHURNED_STATUS, LIVE_STATUSES, VIEW_FACTS, month_states

# Ledger categories, and those that the KPI view reports.
GL_CATEGORIES = ["COGS", "Cash", "G&A", "Other", "R&D", "Sales & Marketing"]
GL_MEASURES = {"cogs": "COGS", "sales_marketing": "Sales & Marketing", "rnd": "R&D", "ga": "G&A"}

# The columns of the KPI view and of the base table, in order.
SPINE_MEASURES = [
    "revenue",
    "new_customers",
    "new_arr_booked",
    *GL_MEASURES,
    "total_marketing_spend",
    "leads",
    "marketing_won_customers",
    "cac",
    "ending_cash",
]
MONTHLY_KPI_COLUMNS = [
    "period",
    *SPINE_MEASURES,
    "active_customers",
    "churned_customers",
    "churn_pct",
    "gross_margin",
    "burn_rate",
    "runway_months",
    "arpu",
    "ltv",
    "ltv_cac",
    "prior_month_arr",
    "arr_growth_pct",
]
KPI_BASE_COLUMNS = [
    "period",
    "revenue",
    "new_customers",
    "new_arr_booked",
    "customer_signups",
    *GL_CATEGORIES,
    "total_marketing_spend",
    "marketing_won_customers",
    "leads",
    "cac",
    "ending_cash",
    "active_customers",
    "churned_customers",
    "churn_pct",
    "gross_margin",
    "burn_rate",
    "runway_months",
    "arr_growth_pct",
    "arpu",
    "ltv",
    "ltv_cac",
]


def monthly_revenue(revenue: DataFrame, keep_void_months: bool = True) -> DataFrame:
    """Recognised (not void) invoice amounts by month; a month of void invoices only is 0 or left out."""
    if not keep_void_months:
        revenue = revenue.filter("NOT coalesce(is_void, false)")
    recognised = "CASE WHEN coalesce(is_void, false) THEN 0 ELSE amount END"
    return aggregate(revenue, ["period"], {"revenue": exact_sum(recognised)})


def monthly_bookings(subscriptions: DataFrame) -> DataFrame:
    """New customers and newly booked ARR by start month, in one aggregate."""
    booked = {"new_customers": "count(DISTINCT customer_id)", "new_arr_booked": exact_sum("arr")}
    return aggregate(subscriptions, ["period"], booked)


def monthly_signups(customers: DataFrame) -> DataFrame:
    dated = customers.filter("signup_date IS NOT NULL")
    return aggregate(
        dated, [f"{month_start('signup_date')} AS period"], {"customer_signups": "count(DISTINCT customer_id)"}
    )


def _category_sum(category: str) -> str:
    return exact_sum(f"CASE WHEN account_category = '{category}' THEN amount ELSE 0 END")


def gl_summary(gl: DataFrame) -> DataFrame:
    """Ledger amounts of the four reported categories by month."""
    return aggregate(gl, ["period"], {name: _category_sum(category) for name, category in GL_MEASURES.items()})


def gl_pivot(gl: DataFrame) -> DataFrame:
    """Ledger amounts by month with one column per category; 0 where there are none."""
    by_category = gl.groupBy("period").pivot("account_category", GL_CATEGORIES)
    return by_category.agg(F.expr(exact_sum("amount"))).fillna(0.0, GL_CATEGORIES)


def monthly_marketing(sales_marketing: DataFrame, round_cac: bool = False) -> DataFrame:
    totals = {
        "total_marketing_spend": exact_sum("spend"),
        "leads": "sum(leads)",
        "marketing_won_customers": "sum(won_customers)",
    }
    cac = ratio("total_marketing_spend", "marketing_won_customers", when="marketing_won_customers > 0")
    return aggregate(sales_marketing, ["period"], totals).selectExpr("*", f"{round2(cac) if round_cac else cac} AS cac")


def monthly_cash(cash: DataFrame) -> DataFrame:
    return aggregate(cash, ["period"], {"ending_cash": exact_sum("ending_cash")})


def churned_customers(subscriptions: DataFrame) -> DataFrame:
    """Distinct customers of cancelled subscriptions by end month."""
    ended = subscriptions.filter(f"subscription_status = '{CHURNED_STATUS}' AND end_date IS NOT NULL")
    return aggregate(
        ended, [f"{month_start('end_date')} AS period"], {"churned_customers": "count(DISTINCT customer_id)"}
    )


def _active_changes(subscriptions: DataFrame) -> DataFrame:
    live = subscriptions.filter(f"subscription_status IN ({literals(LIVE_STATUSES)})")
    return presence_changes(live, "customer_id", "start_date", "end_date")


def active_customers(subscriptions: DataFrame, months: DataFrame) -> DataFrame:
    """Customers with a live subscription on the first day of each given ``month_start``."""
    asked = months.select("month_start").distinct().selectExpr("month_start AS period", "true AS asked")
    return (
        merge_on_period(asked, _active_changes(subscriptions))
        .selectExpr("period", "asked", f"coalesce({running_presence('change')}, 0) AS active_customers")
        .filter("asked")
        .drop("asked")
    )


def _total(part: str, label: str | None = None) -> str:
    """The sum that the states of a part hold."""
    mine = f"part = '{part}'" + (f" AND label = '{label}'" if label else "")
    amount, rest = (f"sum(CASE WHEN {mine} THEN {c} END)" for c in ("amount", "rest"))
    return f"(CAST({amount} AS DOUBLE) + {rest})"


def _number(part: str) -> str:
    return f"sum(CASE WHEN part = '{part}' THEN number END)"


# The measures of a month as sums of its states.
_STATE_MEASURES = {
    "revenue": _total("revenue"),
    "new_customers": _number("bookings"),
    "new_arr_booked": _total("bookings"),
    "total_marketing_spend": _total("marketing", "spend"),
    "leads": _total("marketing", "leads"),
    "marketing_won_customers": _total("marketing", "won_customers"),
    "churned_customers": _number("churned"),
    "change": _number("presence"),
}
_SPINE_PARTS = ["revenue", "bookings", "ledger", "marketing", "cash"]
_CAC = ratio("total_marketing_spend", "marketing_won_customers", when="marketing_won_customers > 0")


def _zero_filled(columns: list[str], keep_null: tuple[str, ...] = ()) -> list[str]:
    return [c if c in keep_null else f"coalesce(`{c}`, 0) AS `{c}`" for c in columns]


def _months(states: DataFrame, in_spine: str, measures: dict[str, str]) -> DataFrame:
    """One row per month of the spine, with the customers who are present at its start.

    Months that only carry a presence change count towards the running sum, so they leave after it.
    """
    all_months = aggregate(states, ["period"], {**_STATE_MEASURES, **measures, "in_spine": f"count_if({in_spine}) > 0"})
    return (
        all_months.selectExpr("*", f"coalesce({running_presence('change')}, 0) AS active_customers")
        .filter("in_spine")
        .drop("in_spine", "change")
    )


def spine_of(states: DataFrame) -> DataFrame:
    """The spine and the customer counts from month states."""
    ledger = {name: _total("ledger", category) for name, category in GL_MEASURES.items()}
    measures = {**ledger, "ending_cash": _total("cash")}
    return _months(states, f"part IN ({literals(_SPINE_PARTS)})", measures).selectExpr("*", f"{_CAC} AS cac")


def kpi_spine(star: Mapping[str, DataFrame]) -> DataFrame:
    """One row per month with activity in any fact; absent measures are 0, an undefined CAC stays NULL."""
    spine = spine_of(month_states(star, VIEW_FACTS))
    return spine.selectExpr("period", *_zero_filled(SPINE_MEASURES, keep_null=("cac",)))


def _margins(cogs: str, burn: str) -> list[str]:
    """Churn, margin, burn and ARPU; a ratio is NULL where it is undefined."""
    return [
        f"{ratio('churned_customers', 'active_customers', when='active_customers > 0')} AS churn_pct",
        f"{ratio(f'revenue - {cogs}', 'revenue', when='revenue <> 0')} AS gross_margin",
        f"{burn} - revenue AS burn_rate",
        f"{ratio('revenue', 'active_customers', when='active_customers > 0')} AS arpu",
    ]


# Formulas over the margins; the second needs the first.
_LIFETIME = [
    f"{ratio('ending_cash', 'burn_rate', when='burn_rate > 0')} AS runway_months",
    f"{ratio('arpu * gross_margin', 'churn_pct', when='churn_pct > 0')} AS ltv",
]
_LTV_CAC = f"{ratio('ltv', 'cac', when='cac > 0')} AS ltv_cac"


def monthly_kpis_of(states: DataFrame) -> DataFrame:
    """The monthly KPI view from month states: one row per month with activity, in month order."""
    measures = [*SPINE_MEASURES, "active_customers", "churned_customers"]
    kpis = (
        spine_of(states)
        .selectExpr("period", *_zero_filled(measures, keep_null=("cac",)))
        .selectExpr("*", *_margins("cogs", "sales_marketing + rnd + ga + cogs"))
        .selectExpr("*", *_LIFETIME)
        .selectExpr("*", _LTV_CAC)
    )
    return with_arr_growth(kpis).select(*MONTHLY_KPI_COLUMNS).orderBy("period")


def monthly_kpis(star: Mapping[str, DataFrame]) -> DataFrame:
    """The monthly KPI view over a star schema."""
    return monthly_kpis_of(month_states(star, VIEW_FACTS))


def with_arr_growth(months: DataFrame) -> DataFrame:
    """Booked ARR of the previous row and the growth over it; a month gap is stepped over."""
    growth = ratio("new_arr_booked - prior_month_arr", "prior_month_arr", when="prior_month_arr <> 0")
    return months.selectExpr("*", "lag(new_arr_booked) OVER (ORDER BY period) AS prior_month_arr").selectExpr(
        "*", f"{growth} AS arr_growth_pct"
    )


def exec_summary(kpis: DataFrame) -> DataFrame:
    """One row: the KPIs of the latest month."""
    latest = {
        "latest_revenue": "revenue",
        "latest_arr_booked": "new_arr_booked",
        "latest_ending_cash": "ending_cash",
        "latest_gross_margin": "gross_margin",
        "latest_churn_pct": "churn_pct",
        "latest_runway_months": "runway_months",
        "latest_cac": "cac",
        "latest_ltv_cac": "ltv_cac",
    }
    return kpis.selectExpr(
        "max(period) AS latest_period", *[f"max_by({column}, period) AS {name}" for name, column in latest.items()]
    )


def kpi_base_of(states: DataFrame) -> DataFrame:
    """The wide monthly base table from month states.

    It differs from ``monthly_kpis``: signups and every ledger category are
    columns, cash-only months are left out, a month has one row per cash entity,
    CAC is rounded and 0 where undefined.
    """
    # a month of void invoices only is none of the spine's
    in_spine = "part IN ('bookings', 'signups', 'ledger', 'marketing') OR part = 'revenue' AND number > 0"
    ledger = {category: _total("ledger", category) for category in GL_CATEGORIES}
    first_entity = {"first_entity": "min(CASE WHEN part = 'cash' THEN label END)"}
    counted = _months(states, in_spine, {**ledger, "customer_signups": _number("signups"), **first_entity})
    counted = counted.selectExpr("*", f"{round2(_CAC)} AS cac")
    cash = aggregate(states.filter("part = 'cash'"), ["period", "label AS entity"], {"ending_cash": _total("cash")})
    months = [c for c in counted.columns if c not in ("period", "first_entity")]
    counted = counted.selectExpr("period", "first_entity", *_zero_filled(months)).selectExpr(
        "*", "lag(new_arr_booked) OVER (ORDER BY period) AS earlier_month_arr"
    )
    # rows go by month and entity: the first entity follows the month before, any other one its own month
    earlier = "CASE WHEN entity = first_entity OR entity IS NULL THEN earlier_month_arr ELSE new_arr_booked END AS earlier"
    growth = ratio("new_arr_booked", "earlier", when="earlier <> 0")
    return (
        counted.join(cash, "period", "left")
        .selectExpr("period", "entity", *[f"`{c}`" for c in months], "coalesce(ending_cash, 0) AS ending_cash", earlier)
        .selectExpr("*", *_margins("`COGS`", "`Sales & Marketing` + `R&D` + `G&A` + `COGS`"), f"{growth} - 1 AS arr_growth_pct")
        .selectExpr("*", *_LIFETIME)
        .selectExpr("*", _LTV_CAC)
        .orderBy("period", "entity")
        .select(*[f"`{c}`" for c in KPI_BASE_COLUMNS])
    )


def kpi_base(star: Mapping[str, DataFrame]) -> DataFrame:
    """The wide monthly base table over a star schema."""
    return kpi_base_of(month_states(star))


def first_months(kpis: DataFrame, n: int = 12) -> DataFrame:
    """The first ``n`` months, as the mart preview shows them."""
    return kpis.orderBy("period").limit(n)
