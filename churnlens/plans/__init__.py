"""Composite jobs: features, segmentation, models, scoring, lifetime value."""
