"""Quarterly fixed-width filings as Spark jobs."""
