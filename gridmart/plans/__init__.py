"""Marts and registered driver queries."""
