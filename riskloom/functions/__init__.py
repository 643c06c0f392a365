"""Column expressions: DataFrame columns in, columns out."""
