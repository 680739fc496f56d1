"""Column expressions: language lookups, point distances, integer division."""
