"""Column expressions with semantics the plain built-ins do not give on their own."""
