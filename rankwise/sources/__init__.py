"""Inputs and outputs: Parquet table scans, raw CSV ingest, result sinks."""
