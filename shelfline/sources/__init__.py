"""Scans: landed envelopes, raw JSON, Parquet layers, the benchmark tables."""
