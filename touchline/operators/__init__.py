"""DataFrame to DataFrame operators; every column name is an argument."""
