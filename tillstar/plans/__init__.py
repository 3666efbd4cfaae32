"""Whole jobs: the layered build, the analysis queries and the export."""
