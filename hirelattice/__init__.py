"""Hiring and sales analytics plus data-quality audits, expressed as Spark jobs."""
