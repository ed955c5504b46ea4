"""Indicators and dimension tables, put together from the operators."""
