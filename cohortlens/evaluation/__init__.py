"""Exact curves, thresholds, metrics, fairness and report tables."""
