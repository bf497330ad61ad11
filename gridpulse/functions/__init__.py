"""Column expressions: no DataFrame in, no DataFrame out."""
