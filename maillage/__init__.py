"""Territorial indicators as lazy Spark plans.

Facts keyed by a small area are cleaned, rolled up to groupings of areas, related
to a population, a surface or a number of years, and delivered in two layouts.
"""
