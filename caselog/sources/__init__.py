"""Readers, writers, declared schemas and load manifests."""
