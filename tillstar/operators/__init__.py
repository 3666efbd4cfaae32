"""DataFrame operators: cleaning, modelling, KPIs, quality checks, report feeds."""
