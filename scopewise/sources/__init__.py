"""Readers and writers: CSV, JSON, file inventories and manifests."""
