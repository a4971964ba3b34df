"""Data-quality checks of the clean tables and the monthly base table, and the raw audit.

A check is a counter; its result is a row (table_name, check_name, issues).
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from saldo.functions.text import clean_value, literals
from saldo.functions.values import parse_date, parse_number, round2
from saldo.operators.aggregate import aggregate
from saldo.operators.checks import (
    count_if,
    nulls,
    run_checks,
    run_keyed_checks,
    run_label_checks,
    surplus_duplicates,
    unexpected_labels,
)
from saldo.sources.tables import LazyTables

# The labels a clean column may hold.
CUSTOMER_STATUSES = ["Active", "Churned", "Paused", "Unknown"]
SUBSCRIPTION_STATUSES = ["Active", "Cancelled", "Paused", "Unknown"]
INVOICE_STATUSES = ["Paid", "Open", "Overdue", "Void", "Unknown"]
CURRENCIES = ["USD", "CAD", "Unknown"]
REGIONS = ["North America", "EMEA", "APAC", "Unknown"]
ENTITIES = ["SaaS HoldCo", "SaaS Canada", "SaaS US", "Unknown"]
GL_CATEGORIES = ["COGS", "Sales & Marketing", "R&D", "G&A", "Cash", "Other"]

# Columns that must not be NULL, by table.
CRITICAL_COLUMNS = {
    "customers": ["customer_id", "customer_name"],
    "subscriptions": ["subscription_id", "customer_id", "start_date"],
    "invoices": ["invoice_id", "customer_id", "invoice_date"],
    "gl": ["gl_txn_id", "txn_date"],
    "cash": ["period", "entity"],
    "kpi_base": ["period"],
}

# The numeric columns of the KPI profile.
PROFILED_KPIS = [
    "revenue",
    "new_customers",
    "new_arr_booked",
    "customer_signups",
    "total_marketing_spend",
    "marketing_won_customers",
    "leads",
    "ending_cash",
    "active_customers",
    "churned_customers",
    "churn_pct",
    "gross_margin",
    "burn_rate",
    "runway_months",
    "cac",
    "arpu",
    "ltv",
    "ltv_cac",
]

# Counters by table and name, as SQL aggregates.
Checks = dict[str, dict[str, str]]

# The key of each table, and the check that counts rows beyond the first of a key.
DUPLICATES: dict[str, tuple[str, tuple[str, ...]]] = {
    "customers": ("duplicate_customer_id", ("customer_id",)),
    "subscriptions": ("duplicate_subscription_id", ("subscription_id",)),
    "invoices": ("duplicate_invoice_id", ("invoice_id",)),
    "gl": ("duplicate_gl_txn_id", ("gl_txn_id",)),
    "cash": ("duplicate_cash_rows", ("period", "entity")),
    "kpi_base": ("duplicate_kpi_periods", ("period",)),
}

CRITICAL_NULLS: Checks = {
    table: {f"null_{table}_{column}": nulls(column) for column in columns}
    for table, columns in CRITICAL_COLUMNS.items()
}

# The labels that each check allows in its column.
ALLOWED_VALUES: dict[str, dict[str, tuple[str, list[str]]]] = {
    "customers": {
        "unexpected_customer_statuses": ("account_status", CUSTOMER_STATUSES),
        "unexpected_region_values": ("region", REGIONS),
    },
    "subscriptions": {
        "unexpected_subscription_statuses": ("subscription_status", SUBSCRIPTION_STATUSES),
        "unexpected_currency_values": ("currency", CURRENCIES),
    },
    "invoices": {"unexpected_invoice_statuses": ("invoice_status", INVOICE_STATUSES)},
    "gl": {"unexpected_gl_categories": ("account_category", GL_CATEGORIES)},
    "cash": {"unexpected_entity_values": ("entity", ENTITIES)},
}


# The columns that checks, labels and month states read, for a build that keeps nothing else.
CHECKED_COLUMNS = {
    "customers": ["customer_id", "customer_name", "signup_date", "account_status", "region"],
    "valid_subscriptions": [
        "subscription_id",
        "customer_id",
        "start_date",
        "end_date",
        "mrr",
        "arr",
        "subscription_status",
        "currency",
    ],
    "invoices": [
        "invoice_id",
        "customer_id",
        "invoice_date",
        "due_date",
        "amount",
        "tax",
        "total_amount",
        "invoice_status",
        "is_void",
    ],
    "gl": ["gl_txn_id", "txn_date", "amount", "account_category"],
    "sales_marketing": ["period", "spend", "leads", "won_customers", "cac"],
    "cash": ["period", "entity", "beginning_cash", "ending_cash"],
}


def date_order(as_of: str | None = None) -> Checks:
    """Dates out of order; a signup is in the future of the given day or of today."""
    today = f"DATE'{as_of}'" if as_of else "current_date()"
    return {
        "customers": {"future_signup_dates": count_if(f"signup_date > {today}")},
        "subscriptions": {"bad_subscription_dates": count_if("end_date < start_date")},
        "invoices": {"bad_invoice_dates": count_if("due_date < invoice_date")},
    }


BUSINESS_RULES: Checks = {
    "subscriptions": {
        "nonpositive_mrr_rows": count_if("mrr <= 0"),
        "nonpositive_arr_rows": count_if("arr <= 0"),
    },
    "sales_marketing": {
        "negative_spend_rows": count_if("spend < 0"),
        "negative_won_customers_rows": count_if("won_customers < 0"),
        "negative_leads_rows": count_if("leads < 0"),
    },
    "cash": {"null_ending_cash_rows": nulls("ending_cash")},
}

_EXPECTED_TOTAL = round2("coalesce(amount, 0) + coalesce(tax, 0)")
INVOICE_MATH: Checks = {
    "invoices": {
        "bad_invoice_math": count_if(f"{round2(f'{_EXPECTED_TOTAL} - coalesce(total_amount, 0)')} <> 0"),
        "void_flag_mismatch": count_if("NOT (is_void <=> coalesce(invoice_status = 'Void', false))"),
    }
}

_EXPECTED_CAC = f"CASE WHEN won_customers > 0 THEN {round2('spend / won_customers')} END"
CAC: Checks = {"sales_marketing": {"cac_mismatch_rows": count_if(f"NOT ({round2('cac')} <=> {_EXPECTED_CAC})")}}

# Reported beside the CAC check, but not part of the issue total.
ZERO_WIN_CAC: Checks = {
    "sales_marketing": {"zero_win_with_cac_rows": count_if("won_customers <= 0 AND cac IS NOT NULL")}
}

KPI_RANGES: Checks = {
    "kpi_base": {
        "negative_kpi_revenue_rows": count_if("revenue < 0"),
        "negative_active_customer_rows": count_if("active_customers < 0"),
        "suspicious_churn_rows": count_if("churn_pct NOT BETWEEN 0 AND 1.5"),
        "suspicious_gross_margin_rows": count_if("gross_margin NOT BETWEEN -5 AND 5"),
        "negative_runway_rows": count_if("runway_months < 0"),
        "negative_cac_rows": count_if("cac < 0"),
    }
}


def checked_tables(clean: Mapping[str, DataFrame]) -> Mapping[str, DataFrame]:
    """The clean tables as the checks read them: none looks at a plan, so subscriptions skip the plan lookup."""
    return LazyTables(lambda name: clean["valid_subscriptions" if name == "subscriptions" else name])


def check_tables(
    tables: Mapping[str, DataFrame], *groups: Checks, duplicates: bool = False, labels: bool = False
) -> DataFrame:
    """Run groups of counters, and on request the duplicate and label checks.

    A table is read once for its counters and duplicates, and once more, down to
    its combinations of labels, for the labels.
    """
    by_table: Checks = {table: {} for table in DUPLICATES} if duplicates else {}
    for group in groups:
        for table, checks in group.items():
            by_table.setdefault(table, {}).update(checks)
    found = []
    for table, checks in by_table.items():
        if duplicates and table in DUPLICATES:
            name, keys = DUPLICATES[table]
            found.append(run_keyed_checks(tables[table], table, keys, name, checks))
        else:
            found.append(run_checks(tables[table], table, checks))
    if labels:
        found += [run_label_checks(tables[table], table, allowed) for table, allowed in ALLOWED_VALUES.items()]
    return reduce(DataFrame.unionByName, found)


def unexpected_values(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every label outside the allowed ones, with its table, check and number of rows."""
    return reduce(
        DataFrame.unionByName,
        [unexpected_labels(tables[table], table, allowed) for table, allowed in ALLOWED_VALUES.items()],
    )


# Columns of the raw tables that must hold a date or a number where they hold anything.
PARSED_COLUMNS = {
    "customers": {"signup_date": parse_date},
    "subscriptions": {
        "start_date": parse_date,
        "end_date": parse_date,
        "mrr": parse_number,
        "discount_pct": parse_number,
    },
    "invoices": {
        "invoice_date": parse_date,
        "due_date": parse_date,
        "amount": parse_number,
        "tax": parse_number,
    },
    "gl": {"txn_date": parse_date, "amount": parse_number},
    "sales_marketing": {
        "period": parse_date,
        "spend": parse_number,
        "leads": parse_number,
        "won_customers": parse_number,
    },
    "cash": {"period": parse_date, "beginning_cash": parse_number, "ending_cash": parse_number},
}


def rejected_values(raw: Mapping[str, DataFrame]) -> DataFrame:
    """Values of raw date and number columns that cleaning takes for missing: (table_name, check_name, issues)."""
    found = []
    for table, parsers in PARSED_COLUMNS.items():
        df = raw[table]
        checks = {
            f"rejected_{column}": count_if(f"{clean_value(df, column)} IS NOT NULL AND {parse(df, column)} IS NULL")
            for column, parse in parsers.items()
        }
        found.append(run_checks(df, table, checks))
    return reduce(DataFrame.unionByName, found)


class Watched:
    """A clean table whose counters are observed while it is written.

    ``table`` is the table with the observation in it. The counters are complete when it has been written: a task of
    a write counts once, however often it is repeated. Rows are numbered per key on the partitioning that the dedup
    left, so that duplicates need no pass of their own. Only for labels outside the allowed ones, their number is
    counted in the written table.
    """

    def __init__(self, df: DataFrame, name: str, as_of: str | None = None) -> None:
        self.name, self.observation = name, Observation()
        groups = [CRITICAL_NULLS, date_order(as_of), BUSINESS_RULES, INVOICE_MATH, CAC]
        counters = {check: counter for group in groups for check, counter in group.get(name, {}).items()}
        self.labels = ALLOWED_VALUES.get(name, {})
        for check, (column, allowed) in self.labels.items():
            counters[check] = count_if(f"{column} NOT IN ({literals(allowed)})")
        if name in DUPLICATES:
            check, keys = DUPLICATES[name]
            key = ", ".join(keys)
            df = df.selectExpr("*", f"row_number() OVER (PARTITION BY {key} ORDER BY {key}) AS _nth")
            counters[check] = count_if("_nth > 1")
        observed = [F.expr(counter).alias(check) for check, counter in counters.items()]
        self.table = df.observe(self.observation, *observed).drop("_nth")

    def counters(self, written: DataFrame) -> DataFrame:
        """The counters as rows (table_name, check_name, issues)."""
        found = self.observation.get
        odd = {check: allowed for check, allowed in self.labels.items() if found[check]}
        rows = [(self.name, check, issues or 0) for check, issues in found.items() if check not in odd]
        counted = written.sparkSession.createDataFrame(rows, "table_name string, check_name string, issues long")
        return counted.unionByName(run_label_checks(written, self.name, odd)) if odd else counted


def summarised(counters: DataFrame) -> DataFrame:
    """Counters with their total and the verdict; the critical NULL counts are one counter."""
    critical = literals([name for checks in CRITICAL_NULLS.values() for name in checks])
    name = f"CASE WHEN check_name IN ({critical}) THEN 'critical_nulls_total' ELSE check_name END AS check_name"
    return (
        aggregate(counters, [name], {"issues": "sum(issues)"})
        .selectExpr("*", "sum(issues) OVER () AS total_issues")
        .selectExpr("*", "CASE WHEN total_issues = 0 THEN 'PASS' ELSE 'WARNING' END AS verdict")
    )


def base_checks(kpi_base: DataFrame) -> DataFrame:
    """The counters of the monthly base table."""
    checks = {"kpi_base": {**CRITICAL_NULLS["kpi_base"], **KPI_RANGES["kpi_base"]}}
    name, keys = DUPLICATES["kpi_base"]
    return run_keyed_checks(kpi_base, "kpi_base", keys, name, checks["kpi_base"])


def issue_summary(tables: Mapping[str, DataFrame], as_of: str | None = None) -> DataFrame:
    """All 32 counters of tables that are not watched, with their total and the verdict."""
    groups = [CRITICAL_NULLS, date_order(as_of), BUSINESS_RULES, INVOICE_MATH, CAC, KPI_RANGES]
    return summarised(check_tables(tables, *groups, duplicates=True, labels=True))


# Counters of the raw audit, by table and figure.
AUDIT_COUNTS: Checks = {
    "customers": {
        "rows": "count(*)",
        "duplicate customer_id": surplus_duplicates("customer_id"),
        "missing industry": nulls("industry"),
    },
    "subscriptions": {"rows": "count(*)"},
    "invoices": {"rows": "count(*)", "duplicate invoice_id": surplus_duplicates("invoice_id")},
    "gl": {"rows": "count(*)"},
}
AUDIT_VALUES = [
    ("customers", "account_status"),
    ("subscriptions", "subscription_status"),
    ("subscriptions", "currency"),
    ("invoices", "invoice_status"),
]


def raw_audit(raw: dict[str, DataFrame], name_sample: int = 15) -> DataFrame:
    """Profile of the raw tables, before any cleaning: (table_name, figure, value), one row per listed value."""
    figures = [
        run_checks(raw[table], table, checks).selectExpr(
            "table_name", "check_name AS figure", "CAST(issues AS STRING) AS value"
        )
        for table, checks in AUDIT_COUNTS.items()
    ]
    values = [_distinct_values(raw[table], table, column) for table, column in AUDIT_VALUES]
    names = _distinct_values(raw["gl"], "gl", "account_name").orderBy("value").limit(name_sample)
    return reduce(DataFrame.unionByName, [*figures, *values, names])


def _distinct_values(df: DataFrame, table: str, column: str) -> DataFrame:
    return (
        df.filter(f"{column} IS NOT NULL")
        .selectExpr(f"'{table}' AS table_name", f"'{column} value' AS figure", f"{column} AS value")
        .distinct()
    )
