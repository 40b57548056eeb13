"""Column expressions: text, JSON-LD fields and display labels."""
