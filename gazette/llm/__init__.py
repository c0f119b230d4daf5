"""Operators of a training-data pipeline, each built by a named method."""
