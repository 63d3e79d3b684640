"""Column expressions: rules (boolean masks) and scalar transforms."""
