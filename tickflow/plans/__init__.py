"""Batch jobs and test-table derivations."""
