"""Occurrence-table curation and analytics as composable Spark transforms."""
