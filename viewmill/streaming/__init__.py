"""The continuous load."""
