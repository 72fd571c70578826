"""Reusable DataFrame operators; none knows the spending tables."""
