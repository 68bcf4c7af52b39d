"""Readers and writers: JSONL, registries, test-case documents, reports, file inventories."""
