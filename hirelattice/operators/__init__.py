"""DataFrame-in, DataFrame-out operators. They take column roles, never table names."""
