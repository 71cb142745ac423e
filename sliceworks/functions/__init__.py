"""Functions of the volume engine."""
