"""Reading and writing: CSV folders, stored tables, the run log and published summaries."""
