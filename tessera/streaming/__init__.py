"""Micro-batch adapters (foreachBatch) for the keyed upsert operators."""
