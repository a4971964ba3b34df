"""Registered queries and their SQL counterparts.

Every query derives the raw finance tables from the given order tables, whole,
and runs the same plans that the pipeline runs on CSV input.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

import oracles
import order_domain
from saldo import pipeline
from saldo.functions import text as X
from saldo.functions.values import parse_date
from saldo.operators.checks import describe
from saldo.operators.dedup import SEQ
from saldo.plans import billing, cleaning, kpis, quality, star
from saldo.plans.months import month_states
from saldo.session import checkpointed, scratch_folder, shuffles_dropped
from saldo.sources.csv_tables import RAW_COLUMNS, malformed_records, read_raw_csv
from saldo.sources.tables import LazyTables, write_csv, write_table

try:  # the operators for training data live in a subpackage that may be left out
    import corpus_pipeline
    from saldo.llm import queries as llm_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "saldo.llm"):
        raise
    corpus_pipeline = llm_queries = None

Query = Callable[[SparkSession, str], DataFrame]


class Finance:
    """The layers over one source folder."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.source = order_domain.source_tables(spark, folder)
        self.raw = LazyTables(lambda name: order_domain.BUILDERS[name](self.source))
        self.clean = LazyTables(self._clean)
        self.dates = LazyTables(lambda name: cleaning.DATES[name](self.raw))
        self.star = LazyTables(self._star)
        self.kpi_star = star.kpi_star(self.clean)
        self.checked = quality.checked_tables(self.clean)

    def _star(self, name: str) -> DataFrame:
        return star.BUILDERS[name](self.dates if name in ("dim_date", "dim_month") else self.clean)

    def intervals(self) -> DataFrame:
        """Valid subscriptions with no more than tells who is present and who has left."""
        return cleaning.subscription_intervals(self.raw["subscriptions"])

    def _clean(self, name: str) -> DataFrame:
        if name == "kpi_base":
            return kpis.kpi_base_of(checkpointed(month_states(self.kpi_star)))
        if name == "subscriptions":
            return cleaning.fill_plans(self.clean["valid_subscriptions"], self.clean["customers"])
        return {**cleaning.BUILDERS, **cleaning.STEPS}[name](self.raw)


Plan = Callable[[Finance], DataFrame]


def _column(table: str, key: str, column: str, standardize: Callable[[str], str]) -> Plan:
    return lambda f: (
        f.raw[table]
        .selectExpr(key, f"{column} AS raw_value", f"{X.strip(column)} AS stripped")
        .selectExpr(key, "raw_value", f"{standardize('stripped')} AS clean_value")
    )


def _clean_text(f: Finance) -> DataFrame:
    """Padded, blank, tabbed and missing text, by the row's key."""
    texts = "array(concat(' ', c_mktsegment, '  '), ' ', concat('\\t', c_mktsegment, '\\n'), NULL, '', c_mktsegment)"
    raw = f.source["customer"].selectExpr("c_custkey", f"{texts}[CAST(c_custkey % 6 AS INT)] AS raw_text")
    return raw.selectExpr("c_custkey", f"{X.clean_text('raw_text')} AS cleaned")


def _kpi_describe(f: Finance) -> DataFrame:
    """The profile with its inexact figures rounded, so that two engines can agree on them."""
    inexact = ("mean", "std", "p25", "p50", "p75")
    profile = describe(f.clean["kpi_base"], quality.PROFILED_KPIS)
    return profile.selectExpr(*[f"round({c}, 4) AS {c}" if c in inexact else c for c in profile.columns])


def _checks(*groups: quality.Checks, **also: bool) -> Plan:
    return lambda f: quality.check_tables(f.checked, *groups, **also)


def _raw_rejects(f: Finance) -> DataFrame:
    """What cleaning takes for missing in raw tables that arrive as text, some of it garbled or in other forms."""

    def date_text(c: str) -> str:
        return f"""CASE day({c}) WHEN 13 THEN concat({c}, ' xyz') WHEN 14 THEN date_format({c}, 'M/d/yyyy')
            WHEN 15 THEN date_format({c}, 'yyyyMMdd') ELSE CAST({c} AS STRING) END"""

    def number_text(c: str) -> str:
        return f"CASE WHEN floor(abs({c})) % 97 = 5 THEN concat('about ', {c}) ELSE CAST({c} AS STRING) END"

    def as_text(name: str) -> DataFrame:
        texts = {
            c: date_text(c) if parse is parse_date else number_text(c)
            for c, parse in quality.PARSED_COLUMNS[name].items()
        }
        return f.raw[name].selectExpr(*[f"{texts[c]} AS {c}" if c in texts else c for c in f.raw[name].columns])

    return quality.rejected_values(LazyTables(as_text))


def _csv_scan(f: Finance) -> DataFrame:
    """Raw customers written as CSV to the shared folder and scanned back as text."""
    raw = f.raw["customers"]
    with scratch_folder(raw.sparkSession) as folder:
        write_csv(raw, folder)
        return checkpointed(read_raw_csv(raw.sparkSession, folder, RAW_COLUMNS["customers"]).drop(SEQ))


def _csv_malformed(f: Finance) -> DataFrame:
    """The records with a field too many, of raw customers in CSV files of which some have one."""
    raw, columns = f.raw["customers"], RAW_COLUMNS["customers"]
    some = "CAST(trim(customer_id) AS BIGINT) % 17 = 0"
    with scratch_folder(raw.sparkSession) as folder:
        write_csv(raw.filter(f"NOT ({some})"), f"{folder}/whole")
        write_csv(raw.filter(some).selectExpr("*", "'surplus' AS surplus"), f"{folder}/wide")
        found = malformed_records(raw.sparkSession, f"{folder}/*", columns)
        return checkpointed(found.selectExpr("split(record, ',')[0] AS customer_id", "fields"))


def _contents(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows of each table, and the number of its distinct first columns: (table_name, row_count, distinct_keys)."""
    counts = [
        df.selectExpr(
            f"'{name}' AS table_name", "count(*) AS row_count", f"count(DISTINCT {df.columns[0]}) AS distinct_keys"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def _written_star(f: Finance, folder: str) -> dict[str, dict[str, DataFrame]]:
    """The star schema and the monthly KPI view over clean tables that are written once, as later readers find them."""
    clean = pipeline.written_layer(f.raw, lambda df, name: write_table(df, f"{folder}/{name}", compression="zstd"))
    dates = checkpointed(star.dim_date(clean))
    mart = {name: builder(clean) for name, builder in star.BUILDERS.items() if name not in ("dim_date", "dim_month")}
    mart |= {"dim_date": dates, "dim_month": star.dim_month(dates)}
    return {"mart": mart, "kpis": {"vw_saas_monthly_kpis": kpis.monthly_kpis(star.kpi_star(clean))}}


def _mart_export(f: Finance) -> DataFrame:
    """The star schema and the monthly KPI view exported as CSV to the shared folder, and what they hold read back."""
    with shuffles_dropped(f.spark), scratch_folder(f.spark) as folder:
        layers = _written_star(f, f"{folder}/clean")
        return checkpointed(_contents(pipeline.export_mart(layers, f"{folder}/export", compression="gzip")))


def _mart_checksums(f: Finance) -> DataFrame:
    """The content of every exported column, as it was written and as it is read back."""
    with shuffles_dropped(f.spark), scratch_folder(f.spark) as folder:
        layers = _written_star(f, f"{folder}/clean")
        return checkpointed(pipeline.checked_export(layers, f"{folder}/export", compression="gzip"))


def _catalog_build(f: Finance) -> DataFrame:
    """The star schema as catalog tables with the KPI views over them, and what they hold read back by name."""
    database = f"saldo_{uuid.uuid4().hex}"
    try:
        with shuffles_dropped(f.spark):
            with scratch_folder(f.spark) as folder:
                built = pipeline.build_catalog(_written_star(f, folder), database)
            by_name = {
                name: f.spark.table(name if name.startswith("vw_") else f"{database}.{name}") for name in built
            }
            return checkpointed(_contents(by_name))
    finally:
        f.spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def _watched_build(f: Finance) -> DataFrame:
    """Counters of all checks: the clean tables written once, counted in the same pass, and the base table over them."""
    with scratch_folder(f.spark) as folder:
        clean, counters = pipeline.checked_layer(
            f.raw, lambda df, name: write_table(df, f"{folder}/{name}"), oracles.AS_OF, narrow=True
        )
        base = kpis.kpi_base_of(checkpointed(month_states(star.kpi_facts(clean))))
        return checkpointed(counters.unionByName(quality.base_checks(base)))


def _dq_duplicates(f: Finance) -> DataFrame:
    names = ", ".join(f"'{name}'" for name, _ in quality.DUPLICATES.values())
    return _watched_build(f).filter(f"check_name IN ({names})")


def _dq_nulls(f: Finance) -> DataFrame:
    names = ", ".join(f"'{name}'" for checks in quality.CRITICAL_NULLS.values() for name in checks)
    return _watched_build(f).filter(f"check_name IN ({names})")


def _arr_growth(f: Finance) -> DataFrame:
    """The growth of booked ARR needs the spine's months only, not the customer counts."""
    spine = kpis.kpi_spine(f.kpi_star).select("period", "new_arr_booked")
    return kpis.with_arr_growth(spine)


PLANS: dict[str, Plan] = {
    "csv_scan": _csv_scan,
    "csv_malformed": _csv_malformed,
    "mart_export": _mart_export,
    "mart_checksums": _mart_checksums,
    "catalog_build": _catalog_build,
    "clean_text": _clean_text,
    "title_case": lambda f: f.source["part"].selectExpr(
        "p_partkey", f"{X.title_case(X.strip('p_name'))} AS titled"
    ),
    "std_status": _column("customers", "customer_id", "account_status", X.std_status),
    "std_region": _column("customers", "customer_id", "region", X.std_region),
    "std_channel": _column("customers", "customer_id", "acquisition_channel", X.std_channel),
    "std_billing": _column("customers", "customer_id", "billing_frequency", X.std_billing),
    "std_plan": _column("subscriptions", "subscription_id", "plan_name", X.std_plan),
    "std_currency": _column("subscriptions", "subscription_id", "currency", X.std_currency),
    "std_entity": _column("gl", "gl_txn_id", "entity", X.std_entity),
    "std_id": _column("subscriptions", "customer_id", "subscription_id", X.std_id),
    "std_side": _column("gl", "gl_txn_id", "dr_cr", X.std_side),
    "gl_category": _column("gl", "gl_txn_id", "account_name", X.gl_category),
    "clean_customers": lambda f: f.clean["customers"],
    "clean_subscriptions": lambda f: f.clean["subscriptions"],
    "clean_invoices": lambda f: f.clean["invoices"],
    "clean_gl": lambda f: f.clean["gl"],
    "clean_sales_marketing": lambda f: f.clean["sales_marketing"],
    "clean_cash": lambda f: f.clean["cash"],
    "dim_date": lambda f: f.star["dim_date"],
    "dim_month": lambda f: f.star["dim_month"],
    "dim_customer": lambda f: f.star["dim_customer"],
    "dim_plan": lambda f: f.star["dim_plan"],
    "dim_account": lambda f: f.star["dim_account"],
    "fact_revenue": lambda f: f.star["fact_revenue"],
    "fact_subscription": lambda f: f.star["fact_subscription"],
    "fact_gl": lambda f: f.star["fact_gl"],
    "fact_sales_marketing": lambda f: f.star["fact_sales_marketing"],
    "fact_cash": lambda f: f.star["fact_cash"],
    "monthly_revenue": lambda f: kpis.monthly_revenue(f.star["fact_revenue"]),
    "monthly_new_customers": lambda f: kpis.monthly_bookings(f.kpi_star["fact_subscription"]).drop("new_arr_booked"),
    "monthly_new_arr": lambda f: kpis.monthly_bookings(f.kpi_star["fact_subscription"]).drop("new_customers"),
    "monthly_signups": lambda f: kpis.monthly_signups(f.star["dim_customer"]),
    "gl_summary": lambda f: kpis.gl_summary(f.star["fact_gl"]),
    "gl_pivot": lambda f: kpis.gl_pivot(f.star["fact_gl"]),
    "monthly_marketing": lambda f: kpis.monthly_marketing(f.star["fact_sales_marketing"]),
    "monthly_cash": lambda f: kpis.monthly_cash(f.star["fact_cash"]),
    "active_customers": lambda f: kpis.active_customers(f.intervals(), f.star["dim_date"]),
    "churned_customers": lambda f: kpis.churned_customers(f.intervals()),
    "kpi_spine": lambda f: kpis.kpi_spine(f.kpi_star),
    "monthly_kpis": lambda f: kpis.monthly_kpis(f.kpi_star),
    "kpi_base": lambda f: f.clean["kpi_base"],
    "exec_summary": lambda f: kpis.exec_summary(kpis.monthly_kpis(f.kpi_star)),
    "arr_growth": _arr_growth,
    "dq_duplicates": _dq_duplicates,
    "dq_nulls": _dq_nulls,
    "dq_allowed_values": _checks(labels=True),
    "dq_unexpected_values": lambda f: quality.unexpected_values(f.checked),
    "dq_rejected_values": _raw_rejects,
    "dq_date_order": _checks(quality.date_order(oracles.AS_OF)),
    "dq_business_rules": _checks(quality.BUSINESS_RULES),
    "dq_invoice_math": _checks(quality.INVOICE_MATH),
    "dq_cac": _checks(quality.CAC, quality.ZERO_WIN_CAC),
    "dq_kpi_ranges": _checks(quality.KPI_RANGES),
    "dq_summary": lambda f: quality.summarised(_watched_build(f)),
    "kpi_describe": _kpi_describe,
    "raw_audit": lambda f: quality.raw_audit(f.raw),
    "mart_row_counts": lambda f: star.kept_row_counts(f.raw, f.clean),
    "top12_months": lambda f: kpis.first_months(kpis.monthly_kpis(f.kpi_star), 12),
    "billing_schedule": lambda f: billing.billing_schedule(f.raw["subscriptions"], oracles.HORIZON),
}


def entry(spark: SparkSession) -> DataFrame:
    """The monthly KPI view on the smallest data set."""
    return queries()["monthly_kpis"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Query]:
    """One entry per operator: (spark, folder) -> DataFrame."""
    found = {name: lambda spark, folder, plan=plan: plan(Finance(spark, folder)) for name, plan in PLANS.items()}
    if llm_queries is not None:
        found |= llm_queries.QUERIES
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    """The same results in SQL over the same tables."""
    found = {name: oracles.statement(name) for name in PLANS}
    if llm_queries is not None:
        found |= llm_queries.SQL
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
