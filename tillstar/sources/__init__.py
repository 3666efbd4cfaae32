"""Where rows come from: CSV extracts, the region lookup, driver-table adapters."""
