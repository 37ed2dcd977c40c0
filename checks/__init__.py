"""Registered queries over the given tables and independent SQL for each."""
