"""Composed jobs: classifiers and tuning, reports, derived inputs, registry."""
