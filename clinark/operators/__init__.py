"""Normalisers, gold aggregates, ordered slices and serving queries (DataFrame → DataFrame)."""
