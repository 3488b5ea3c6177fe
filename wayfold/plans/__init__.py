"""Whole plans: fixtures, batch entry points, queries and their SQL."""
