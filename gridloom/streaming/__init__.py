"""Scheduled runs as micro-batches."""
