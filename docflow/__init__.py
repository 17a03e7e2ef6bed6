"""Governed document analytics as Spark DataFrame operators."""
