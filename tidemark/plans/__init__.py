"""Composed plans: feature tables, training/scoring, and the registered queries."""
