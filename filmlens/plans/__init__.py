"""Composed jobs: catalog searches, feature frames, models and reports."""
