"""Whole conversions built from the operators."""
