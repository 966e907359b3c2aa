"""Stateless operators on arriving files."""
