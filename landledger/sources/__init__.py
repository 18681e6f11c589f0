"""Readers, extracts, seeds and the binding of the shared test tables."""
