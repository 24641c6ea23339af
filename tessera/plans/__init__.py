"""Composed queries."""
