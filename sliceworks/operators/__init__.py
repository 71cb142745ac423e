"""Operators of the volume engine."""
