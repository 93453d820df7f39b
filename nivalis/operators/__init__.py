"""Operators on tables of pixels and days."""
