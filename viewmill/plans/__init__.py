"""Whole jobs built from the operators: star load and daily marts."""
