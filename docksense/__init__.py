"""Shared-mobility analytics expressed as Spark DataFrame operators."""
