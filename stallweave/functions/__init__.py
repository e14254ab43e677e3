"""Column helpers: casts, JSON access, text, clocks, vectors."""
