"""Readers and writers: JSON, CSV, file lists, manifests, the load ledger."""
