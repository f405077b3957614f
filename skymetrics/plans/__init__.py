"""Composed plans: the single-scan dashboard and the registered query catalog."""
