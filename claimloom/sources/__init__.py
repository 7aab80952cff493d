"""Readers and writers: claims, lookups, batches, run logs and model bundles."""
