"""Reusable DataFrame operators: running totals, key checks, shares and the issue log."""
