"""Readers and writers: raw JSON envelopes, Parquet tables, generated and derived sources."""
