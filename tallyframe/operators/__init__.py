"""Table operators: every function takes a DataFrame and returns a DataFrame."""
