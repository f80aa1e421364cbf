"""Fixtures derived from the test tables, and the query / oracle catalog."""
