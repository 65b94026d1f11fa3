"""Column expressions: text cleaning, fixed word lists, sparse-vector access."""
