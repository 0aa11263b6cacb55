"""Loads, reports and rules composed from the operators."""
