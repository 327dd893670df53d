"""Composite jobs built from the operators (what a user calls)."""
