"""Readers and writers (Parquet / CSV / lake paths)."""
