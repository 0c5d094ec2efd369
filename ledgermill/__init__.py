"""Spark jobs that turn messy retail transaction text into staging tables, marts, checks and reports."""
