"""The registered queries in plain SQL, for comparison by another engine."""
