"""Column expressions. Everything here stays on built-in Spark functions."""
