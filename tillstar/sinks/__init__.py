"""Where rows go: layered tables, views and CSV snapshots."""
