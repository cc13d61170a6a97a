"""Guardlake: responsible-AI score analytics expressed as Spark DataFrame jobs."""
