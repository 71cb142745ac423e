"""Plans of the volume engine."""
