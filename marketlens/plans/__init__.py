"""Whole query plans built from the operators."""
