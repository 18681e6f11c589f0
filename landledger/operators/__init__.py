"""Cleaning, dimension and fact builders, upserts and quality checks."""
