"""Readers and writers: driver tables, JSON array ingestion, table paths."""
