"""Composed jobs, the registered query set and plan inspection helpers."""
