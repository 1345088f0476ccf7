"""Column expressions: positions, keys, literals, types and value comparison."""
