"""The alert rule as a stream over published summaries."""
