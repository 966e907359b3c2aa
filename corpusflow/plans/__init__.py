"""Chains of operators and the checked queries."""
