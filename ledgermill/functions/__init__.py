"""Column expressions: text parsing, calendar parts and buckets."""
