"""Column expressions shared by the operators and query plans."""
