"""Retail star schema, KPIs and data-quality reports as Spark DataFrame operators."""
