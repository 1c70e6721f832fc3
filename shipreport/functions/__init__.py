"""Column expressions: no function here reads or moves rows."""
