"""Subscription finance analytics as Spark DataFrame plans.

Layers, each a set of lazy ``DataFrame -> DataFrame`` functions:

``sources``    raw tables in (CSV, order-domain parquet), tables and exports out
``functions``  column expressions: text standardizers, value parsing, sums
``operators``  reusable table operators: keep-one dedup, monthly presence, checks
``plans``      the domain: cleaning, star schema, KPIs, data quality, billing
"""
