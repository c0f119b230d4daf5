"""Composed jobs: silver, gold and ingest."""
