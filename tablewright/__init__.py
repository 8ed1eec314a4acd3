"""Tablewright: record tables, page extraction and entity resolution as Spark jobs."""
