"""Stateless operators applied to streaming tables."""
