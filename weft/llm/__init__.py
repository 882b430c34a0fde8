"""Operators of a training-data pipeline (nothing else in weft imports them)."""
