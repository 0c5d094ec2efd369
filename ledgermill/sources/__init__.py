"""Reading and writing: CSV ingest, Parquet layers and the reshaped test tables."""
