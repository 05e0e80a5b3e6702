"""DataFrame operators: each takes a DataFrame, column names and parameters."""
