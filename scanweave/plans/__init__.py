"""Batch runs and the registered queries."""
