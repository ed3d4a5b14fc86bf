"""Whole analyses composed of operators, and views of the driver tables."""
