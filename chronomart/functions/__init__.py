"""Column expressions: hashing, parsing, arrays and text."""
