"""Composed plans: fixture adapters, the layered build and the query catalogue."""
