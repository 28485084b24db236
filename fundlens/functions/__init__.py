"""Column expressions. No Python code runs per row."""
