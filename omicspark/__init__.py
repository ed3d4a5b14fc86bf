"""Transcript quantification and annotation analytics as Spark DataFrame operators."""
