"""Spells, prediction grid, window / as-of features, labels, assembly."""
