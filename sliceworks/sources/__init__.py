"""Sources of the volume engine."""
