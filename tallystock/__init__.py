"""Inventory-count analytics as Spark DataFrame code."""
